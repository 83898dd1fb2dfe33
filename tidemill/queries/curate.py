from pyspark.sql import functions as F

from tidemill.operators import curate
from tidemill.operators.split import hash_split
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import per_position, query, rounded, sql_round, sql_split, table

WANTED = ["src0", "src3", "src5", "src8", "src11", "src13", "src17", "src19"]
ABSENT = ["src3", "src8", "src90", "src91"]
from tidemill.sources.sinks import Manifest


def _listing(spark, sf_dir, label="source"):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col(label).alias("label"), "n_chars")
    return hash_split(documents, "doc_id", 0.2)


@query("class_subset", f"""
    SELECT doc_id, source AS label, n_chars FROM documents WHERE source IN ({', '.join(repr(c) for c in WANTED)})""")
def class_subset(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("label"), "n_chars")
    return curate.class_subset(documents, WANTED)


@query("missing_classes", f"""
    WITH want AS (SELECT * FROM (VALUES ('train'), ('validation'), ('test')) s(split), (VALUES {', '.join(f"('{c}')" for c in ABSENT)}) c(label)),
    have AS (SELECT DISTINCT {sql_split('doc_id', 0.2)} AS split, source AS label FROM documents)
    SELECT split, label FROM want WHERE (split, label) NOT IN (SELECT (split, label) FROM have)""")
def missing_classes(spark, sf_dir):
    return curate.missing_classes(_listing(spark, sf_dir), ABSENT, ["train", "validation", "test"])


@query("link_status", """
    SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'exists' ELSE 'linked' END AS status FROM documents""")
def link_status(spark, sf_dir):
    """Documents already present in the label table are reported, the others added."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return curate.link_once(documents, table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", "status")


@query("link_repeats", """
    WITH d AS (SELECT CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 50 END AS k FROM documents), m AS (SELECT DISTINCT doc_id % 40 AS k FROM labels WHERE doc_id % 3 = 0)
    SELECT k, count(*) FILTER (WHERE r = 1 AND NOT known)::BIGINT AS linked, count(*)::BIGINT AS n
    FROM (SELECT d.k, row_number() OVER (PARTITION BY d.k) AS r, m.k IS NOT NULL AS known FROM d LEFT JOIN m ON d.k IS NOT DISTINCT FROM m.k) GROUP BY k""")
def link_repeats(spark, sf_dir):
    """Repeated and missing keys are linked once."""
    entries = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 9 != 0, F.col("doc_id") % 50).alias("k"))
    manifest = table(spark, sf_dir, "labels").where("doc_id % 3 = 0").select((F.col("doc_id") % 40).alias("k"))
    marked = curate.link_once(entries, manifest, "k")
    return marked.groupBy("k").agg(F.count_if(F.col("status") == "linked").alias("linked"), F.count(F.lit(1)).alias("n"))


@query("split_listing", f"""
    SELECT split, string_agg(label, ',' ORDER BY label) AS classes
    FROM (SELECT DISTINCT {sql_split('doc_id', 0.2)} AS split, source AS label FROM documents) GROUP BY split""")
def split_listing(spark, sf_dir):
    return curate.split_listing(_listing(spark, sf_dir)).select("split", F.array_join("classes", ",").alias("classes"))


@query("class_count", "SELECT count(DISTINCT source)::BIGINT AS n_classes FROM documents")
def class_count(spark, sf_dir):
    return curate.class_count(table(spark, sf_dir, "documents"), "source")


@query("class_index", """
    WITH d AS (SELECT source, (row_number() OVER (ORDER BY source) - 1)::INT AS class_index FROM (SELECT DISTINCT source FROM documents))
    SELECT doc_id, source, class_index FROM documents JOIN d USING (source)""")
def class_index(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return curate.with_class_index(documents, "source").select("doc_id", "source", "class_index")


@query("sample_counts", f"""
    SELECT split, label, count(*)::BIGINT AS n, GROUPING(split, label)::INTEGER AS level FROM (SELECT {sql_split('doc_id', 0.2)} AS split, source AS label FROM documents)
    GROUP BY ROLLUP (split, label)""")
def sample_counts(spark, sf_dir):
    return curate.sample_counts(_listing(spark, sf_dir))


@query("one_hot", """
    SELECT vec_id, pos::INT AS pos, (label = pos)::INT::DOUBLE AS value FROM embeddings, range(10) r(pos)""")
def one_hot(spark, sf_dir):
    coded = curate.one_hot(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", 10)
    return per_position(coded, ["vec_id"], "one_hot")


@query("profile_arrays", f"""
    SELECT 'embedding' AS "column", count(*)::BIGINT AS n_rows, min(len(embedding))::INT AS min_length, max(len(embedding))::INT AS max_length,
           {sql_round('min(list_min(embedding))::DOUBLE')} AS min_value, {sql_round('max(list_max(embedding))::DOUBLE')} AS max_value,
           {sql_round('min(list_min(embedding))::DOUBLE / 255', 8)} AS min_scaled, {sql_round('max(list_max(embedding))::DOUBLE / 255', 8)} AS max_scaled
    FROM embeddings""")
def profile_arrays(spark, sf_dir):
    p = curate.profile(table(spark, sf_dir, "embeddings"), ["embedding"])
    return p.withColumns({
        "min_value": rounded(F.col("min_value")), "max_value": rounded(F.col("max_value")),
        "min_scaled": rounded(F.col("min_scaled"), 8), "max_scaled": rounded(F.col("max_scaled"), 8)})


@query("concurrent_links", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'F') OR o_orderpriority < '3'""")
def concurrent_links(spark, sf_dir):
    """Two runs that overlap, the later one committing first, and a repeat of both: each order is linked once."""
    orders = table(spark, sf_dir, "orders")
    manifest = Manifest(spark, scratch_dir(spark, "manifest"), "o_orderkey", "o_orderkey long, o_orderstatus string")
    one, two = orders.where("o_orderstatus IN ('O', 'F')"), orders.where("o_orderpriority < '3'")
    first, second = manifest.prepare(one), manifest.prepare(two)
    manifest.commit(*second)
    manifest.commit(*first)
    manifest.append(one.unionByName(two))
    return manifest.read()


@query("bloom_subset", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def bloom_subset(spark, sf_dir):
    """Orders of some customers, as if these were too many to send: a Bloom filter before the shuffle join."""
    wanted = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select("c_custkey")
    return curate.class_subset(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), wanted, "o_custkey", limit=0)
