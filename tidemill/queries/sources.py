from pyspark.sql import functions as F

from tidemill.operators.curate import attach_names
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import query, rounded, sql_round, sql_u32, table
from tidemill.sources import arrays
from tidemill.sources.files import read_images, read_numeric_csv, with_path_labels, with_shape_check
from tidemill.sources.sinks import read_dataset, write_dataset, write_images
from tidemill.sources.synthetic import grid, sample_points
from tidemill.operators.split import hash_split
from tidemill.queries.registry import sql_split


@query("numeric_csv", """
    SELECT year(o_orderdate)::INT AS year, count(*)::BIGINT AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total
    FROM orders GROUP BY 1""")
def numeric_csv(spark, sf_dir):
    """Orders written as a headerless CSV, read back with declared types."""
    path = scratch_dir(spark, "csv")
    trend = table(spark, sf_dir, "orders").select(F.year("o_orderdate"), F.round(F.col("o_totalprice") * 100).cast("long"))
    trend.write.csv(path, header=False)
    rows = read_numeric_csv(spark, path, "year INT, price BIGINT")
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))


@query("path_label", """
    WITH p AS (SELECT page_id, string_split(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '/') AS parts FROM pages)
    SELECT page_id, parts[-3] AS split, parts[-2] AS label FROM p""")
def path_label(spark, sf_dir):
    """Class and split folders parsed from page addresses."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.rtrim(F.regexp_replace("url", "[?#].*$", ""), F.lit("/")).alias("path"))
    return with_path_labels(pages).drop("path")


@query("array_shape", """
    SELECT label::INT AS label, count(*)::BIGINT AS n, count(*) FILTER (len(embedding) = 8 * 8 * 1)::BIGINT AS n_ok
    FROM embeddings GROUP BY label""")
def array_shape(spark, sf_dir):
    checked = with_shape_check(table(spark, sf_dir, "embeddings"), (8, 8, 1), "embedding")
    return checked.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("shape_ok").alias("n_ok"))


@query("label_names", """
    SELECT doc_id, quality::INT AS class_index, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS name FROM labels""")
def label_names(spark, sf_dir):
    names = spark.createDataFrame([(0, "low"), (1, "high")], "class_index int, name string")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("class_index"))
    return attach_names(labels, names).select("doc_id", "class_index", "name")


@query("synth_cosine", f"""
    WITH p AS (SELECT o_orderkey, -3 + 6 * ({sql_u32('7:x1', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x1,
                      -3 + 6 * ({sql_u32('7:x2', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x2 FROM orders)
    SELECT o_orderkey, {sql_round('x1')} AS x1, {sql_round('x2')} AS x2, {sql_round('cos(2 * x1) + cos(3 * x2)')} AS y FROM p""")
def synth_cosine(spark, sf_dir):
    """A surface sample per order: as many points as the table has rows."""
    points = sample_points(table(spark, sf_dir, "orders"), "o_orderkey", -3.0, 3.0, seed=7)
    return points.select("o_orderkey", *[rounded(F.col(c)).alias(c) for c in ("x1", "x2", "y")])


GRID_STEPS = 50


@query("grid_points", f"""
    WITH r AS (SELECT min(l_quantity) q0, max(l_quantity) q1, min(l_extendedprice) p0, max(l_extendedprice) p1 FROM lineitem),
    c AS (SELECT floor((l_quantity - q0) / (q1 - q0) * 49 + 0.5)::BIGINT + 50 * floor((l_extendedprice - p0) / (p1 - p0) * 49 + 0.5)::BIGINT AS id,
                 count(*) AS n FROM lineitem, r GROUP BY 1),
    g AS (SELECT unnest(range(2500)) AS id)
    SELECT g.id::BIGINT AS id, {sql_round('(g.id % 50) / 49.0::DOUBLE')} AS x1, {sql_round('(g.id // 50) / 49.0::DOUBLE')} AS x2, coalesce(n, 0)::BIGINT AS n
    FROM g LEFT JOIN c ON g.id = c.id""")
def grid_points(spark, sf_dir):
    """A 50 x 50 grid over the observed range of two columns, with the rows nearest to each point."""
    items = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    ranges = items.agg(F.struct(
        F.min("l_quantity").alias("q0"), F.max("l_quantity").alias("q1"),
        F.min("l_extendedprice").alias("p0"), F.max("l_extendedprice").alias("p1"))).scalar()
    last = GRID_STEPS - 1
    cell = items.withColumn("_r", ranges).select((
        F.floor((F.col("l_quantity") - F.col("_r.q0")) / (F.col("_r.q1") - F.col("_r.q0")) * last + 0.5)
        + GRID_STEPS * F.floor((F.col("l_extendedprice") - F.col("_r.p0")) / (F.col("_r.p1") - F.col("_r.p0")) * last + 0.5)
    ).alias("id"))
    counts = cell.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    # Counts have at most one row per grid point.
    points = grid(spark, 0.0, 1.0, GRID_STEPS).join(F.broadcast(counts), "id", "left")
    return points.select("id", rounded(F.col("x1")).alias("x1"), rounded(F.col("x2")).alias("x2"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("dataset_roundtrip", f"""
    SELECT {sql_split('doc_id', 0.2)} AS split, count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars
    FROM documents WHERE lang = 'en' GROUP BY 1""")
def dataset_roundtrip(spark, sf_dir):
    """Documents written by split and class, one class read back through partition pruning."""
    path = scratch_dir(spark, "dataset")
    documents = table(spark, sf_dir, "documents").withColumnRenamed("lang", "label")
    write_dataset(hash_split(documents, "doc_id", 0.2), path)
    english = read_dataset(spark, path).where(F.col("label") == "en")
    return english.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("array_files", """
    SELECT vec_id, label::INT AS label, len(embedding)::INT AS size, embedding[1]::DOUBLE AS first, embedding[64]::DOUBLE AS last
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL""")
def array_files(spark, sf_dir):
    """Vectors and labels written as array files by the tasks, and read back in byte ranges."""
    path = scratch_dir(spark, "array-files")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    arrays.write_array_files(vectors.where("label IS NOT NULL AND embedding IS NOT NULL").repartition(4), path, split_bytes=1 << 20)
    back = arrays.read_array_files(spark, path, columns=["vec_id", "label", "embedding"], split_bytes=1 << 18)
    return back.select("vec_id", "label", F.size("embedding").alias("size"), F.col("embedding")[0].cast("double").alias("first"), F.col("embedding")[63].cast("double").alias("last"))


@query("array_labels", "SELECT label::INT AS label, count(*)::BIGINT AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1")
def array_labels(spark, sf_dir):
    """Label counts from array files, whose images are not opened."""
    path = scratch_dir(spark, "array-files")
    vectors = table(spark, sf_dir, "embeddings").where("label IS NOT NULL AND embedding IS NOT NULL")
    arrays.write_array_files(vectors.select(F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("pixels")), path)
    return arrays.read_array_files(spark, path, columns=["label"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("decoded_images", """
    SELECT label::VARCHAR AS label, (vec_id // 256)::VARCHAR AS name, count(*)::INT AS height, 64::INT AS width, sum(p)::BIGINT AS total
    FROM (SELECT label, vec_id, list_sum(list_transform(embedding, lambda v: least(greatest(floor(v::DOUBLE * 64 + 128), 0), 255))) AS p
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL) GROUP BY 1, 2""")
def decoded_images(spark, sf_dir):
    """Vectors as rows of grey pictures, written as PNG files into class folders and decoded again."""
    root = scratch_dir(spark, "images")
    vectors = table(spark, sf_dir, "embeddings").where("label IS NOT NULL AND embedding IS NOT NULL")
    levels = F.transform("embedding", lambda v: F.least(F.greatest(F.floor(v.cast("double") * 64 + 128), F.lit(0)), F.lit(255)).cast("int"))
    # A picture holds 256 vectors at most.
    pictures = vectors.groupBy(F.col("label").cast("string").alias("label"), F.expr("vec_id DIV 256").cast("string").alias("name")).agg(
        F.array_sort(F.collect_list(F.struct("vec_id", levels.alias("p")))).alias("rows"))
    flat = F.flatten(F.transform("rows", lambda r: r["p"]))
    write_images(pictures.select(F.lit("train").alias("split"), "label", "name", F.size("rows").alias("height"), F.lit(64).alias("width"), F.lit(1).alias("channels"), flat.alias("pixels")), root)
    decoded = read_images(spark, root, "*.png")
    total = F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v).cast("long")
    return decoded.select("label", F.regexp_extract("path", r"([^/]+)[.]png$", 1).alias("name"), "height", "width", total.alias("total"))
