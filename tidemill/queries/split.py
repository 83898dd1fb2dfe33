from pyspark.sql import functions as F

from tidemill.operators import split
from tidemill.queries.registry import query, sql_split, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey")


@query("hash_split", f"SELECT o_orderkey, {sql_split('o_orderkey', 0.2)} AS split FROM orders")
def hash_split(spark, sf_dir):
    return split.hash_split(_orders(spark, sf_dir), "o_orderkey", 0.2)


@query("exact_split", """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) <= ceil(count(*) OVER () * 0.33::DOUBLE)
           THEN 'test' ELSE 'train' END AS split FROM orders""")
def exact_split(spark, sf_dir):
    return split.exact_split(_orders(spark, sf_dir), "o_orderkey", 0.33)


@query("class_split", """
    SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) <= floor(count(*) OVER (PARTITION BY source) * 0.2::DOUBLE)
           THEN 'validation' ELSE 'train' END AS split FROM documents""")
def class_split(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return split.class_split(documents, "doc_id", 0.2, "source").select("doc_id", "source", "split")


@query("global_rank", """
    SELECT o_orderkey, row_number() OVER (ORDER BY md5('0:' || o_orderkey), o_orderkey)::BIGINT AS rank FROM orders""")
def global_rank(spark, sf_dir):
    return split.global_row_number(_orders(spark, sf_dir), "o_orderkey")


@query("shuffle_epoch", """
    SELECT o_orderkey, epoch::INT AS epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || o_orderkey), o_orderkey)::BIGINT AS position
    FROM orders, range(2) e(epoch)""")
def shuffle_epoch(spark, sf_dir):
    """The sample order of two epochs."""
    epochs = [split.shuffle_epoch(_orders(spark, sf_dir), "o_orderkey", 42, e).withColumn("epoch", F.lit(e)) for e in range(2)]
    return epochs[0].unionByName(epochs[1])


@query("assign_batches", """
    WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:0:' || o_orderkey), o_orderkey) - 1 AS z, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, (z // 32)::BIGINT AS batch_id, (z % 32)::INT AS pos FROM r WHERE z // 32 < n // 32""")
def assign_batches(spark, sf_dir):
    return split.assign_batches(_orders(spark, sf_dir), "o_orderkey", 32)


@query("take_first", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def take_first(spark, sf_dir):
    """The evaluation cutoff: the first 1,000 samples in key order."""
    return split.take_first(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000)
