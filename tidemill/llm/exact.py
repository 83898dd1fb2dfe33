"""Exact deduplication by keyed streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BROADCAST_BYTES, kept, narrow
from tidemill.plans.scratch import scratch_dir

_STORE = "spark.sql.streaming.stateStore"
#: RocksDB state whose commits upload changes instead of snapshots, and whose many small stores don't reserve disk ahead.
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}


def normalised(text: str = "text"):
    """Null counts as empty; every run of ASCII white space is one space."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text):
    return F.sha2(text.cast("binary"), 256)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", locator: str = "locator", digest=sha256) -> DataFrame:
    """What the state needs of a row: identifier, locator of the content, digest.  Works on a batch and on a stream."""
    return docs.select(F.col(key).alias("doc_id"), F.col(locator).alias("locator"), digest(normalised(text)).alias("digest"))


def seen(prints: DataFrame) -> DataFrame:
    """Per digest the holder (smallest identifier, then smallest locator; a null identifier comes last) and the rows so far.

    On a stream this is keyed state without watermark or expiry.
    """
    holder = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("locator"))
    return prints.groupBy("digest").agg(F.min(holder).alias("holder"), F.count(F.lit(1)).alias("group_size"))


def run_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Feeds a folder of fingerprints to the state and returns the state's last entries.

    State lies in RocksDB on the executors' disks with its checkpoint in the
    shared folder.  Each micro-batch writes the entries it changed, under its
    own number, so a repeated batch replaces itself.
    """
    out, log = scratch_dir(spark, "state-entries"), scratch_dir(spark, "state-log")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    try:
        for k, v in STATE_SETTINGS.items():
            spark.conf.set(k, v)
        writer = seen(reader.parquet(path)).writeStream.outputMode("update").option("checkpointLocation", log)
        writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    shape = seen(spark.createDataFrame([], schema)).schema
    entries = spark.read.schema(shape).parquet(out)
    return entries.groupBy("digest").agg(F.min("holder").alias("holder"), F.max("group_size").alias("group_size"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", locator: str | None = None, digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space normalisation; the row
    with the smallest identifier stays.  Rows of one digest are compared with
    the holder's bytes, found by locator; a row whose bytes differ (digests
    collided) is grouped again by its full text.

    `locator` names a column that tells rows apart and stays the same when
    the table is read again, such as file and row number; without it the table
    is kept once, with a number per row.

    Null text counts as empty.  A null identifier sorts after all others; of
    rows repeated with one identifier exactly one is kept.  An empty table
    gives an empty result.  Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    if locator is None:
        locator = "locator"
        docs = kept(docs.select(F.col(key), F.col(text), F.monotonically_increasing_id().cast("string").alias(locator)), "located")
    prints = fingerprints(docs, key, text, locator, digest)
    path = scratch_dir(spark, "fingerprints")
    prints.write.parquet(path)
    prints = spark.read.schema(prints.schema).parquet(path)
    state = kept(run_stream(spark, path, prints.schema, files_per_batch), "state")

    hits = prints.join(state.where("group_size > 1").select("digest", "holder"), "digest")
    hits = kept(hits.select("doc_id", "locator", "digest", (F.col("locator") == F.col("holder.locator")).alias("is_holder")), "hits")
    width = hits.agg(F.max(F.octet_length("locator") + F.octet_length("digest"))).first()[0] or 0
    few = narrow(hits, BROADCAST_BYTES // (width + 100))
    bodies = docs.select(F.col(locator).alias("locator"), normalised(text).alias("body")).join(few, "locator")
    bodies = kept(bodies, "hit-bodies")
    first = bodies.where("is_holder").select("digest", F.col("body").alias("held"))
    odd = kept(bodies.join(first, "digest").where("body <> held").select("doc_id", "locator", "digest", "body"), "collided")

    plain = prints.join(state, "digest")
    if odd.limit(1).count():
        plain = prints.join(odd.select("locator"), "locator", "left_anti")
        plain = plain.join(_groups(plain, "digest"), "digest")
        again = odd.join(_groups(odd, "body"), "body")
        plain = plain.select("doc_id", "locator", "holder", "group_size").union(again.select("doc_id", "locator", "holder", "group_size"))
    out = plain.select("doc_id", F.col("holder.doc_id").alias("keep_id"), "group_size", (F.col("locator") == F.col("holder.locator")).alias("kept"), *(["digest"] if digest is sha256 and "digest" in plain.columns else ["locator"]))
    if "digest" in out.columns:
        return out.withColumnRenamed("digest", "text_sha256")
    exact = docs.select(F.col(locator).alias("locator"), sha256(normalised(text)).alias("text_sha256"))
    return out.join(exact, "locator").drop("locator")


def _groups(rows: DataFrame, by: str) -> DataFrame:
    return seen(rows.drop("digest").withColumnRenamed(by, "digest") if by != "digest" else rows).withColumnRenamed("digest", by)


def located(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with file and row number as locator."""
    return spark.read.parquet(path).select("*", F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("locator"))
