"""Helpers that several operators share: kept tables and joins on a measured side."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.scratch import scratch_dir

#: Rows of at most some tens of bytes that may be sent to every executor.
BROADCAST_ROWS = 1_000_000
#: Bytes of longer rows, in a table's own form, that may be sent to every executor.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read back: lineage ends here and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of an Arrow batch at most, for the jobs run inside: what a Python worker has in hand of long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def narrow(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side of few, short rows for broadcast after counting it; a larger one is left to a shuffle join.

    The count is taken of a kept table, so it costs a read of file footers.
    """
    return F.broadcast(side) if side.count() <= rows else side


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of (a, b) links: rows (id, component), component being the smallest id reachable.

    Every node points to its smallest neighbour, then pointers are doubled
    until nothing changes; links inside a tree vanish, the others are carried
    to the roots.  Only ids move, each round is written to the scratch folder,
    and a hub of many links is reduced by map-side minima.
    """
    spark = links.sparkSession
    edges = kept(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    labels = None
    while True:
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edges.select(F.col("b").alias("id"), F.col("a").alias("to")))
        parent = kept(ends.groupBy("id").agg(F.least(F.min("id"), F.min("to")).alias("up")), f"{name}-parent")
        while True:  # pointer doubling: depth halves each time
            above = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
            step = kept(parent.join(above, "up").select("id", F.col("top").alias("new"), "up"), f"{name}-jump")
            moved = step.where("new <> up").limit(1).count()
            parent = step.select("id", F.col("new").alias("up"))
            if not moved:
                break
        if labels is None:
            labels = parent.select("id", F.col("up").alias("component"))
        else:
            top = parent.select(F.col("id").alias("component"), "up")
            labels = kept(labels.join(top, "component", "left").select("id", F.coalesce("up", "component").alias("component")), f"{name}-labels")
        a = parent.select(F.col("id").alias("a"), F.col("up").alias("ra"))
        b = parent.select(F.col("id").alias("b"), F.col("up").alias("rb"))
        left = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = kept(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
        if not edges.limit(1).count():
            return labels
