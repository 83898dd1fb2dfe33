"""Input of an iterative job: read once, kept, and evenly spread."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextmanager
def kept(df: DataFrame, source: DataFrame | None = None) -> Iterator[DataFrame]:
    """Persist for the duration of a fit, unless the caller holds ``source`` persisted already.

    Every pass waits for the fullest partition.  If one holds more than twice
    an even share per core (a file with one row group, a skewed producer), the
    kept rows are spread again once, which the passes then repay.
    """
    held_by_caller = (source or df).storageLevel
    if held_by_caller.useMemory or held_by_caller.useDisk:
        yield df
        return
    held = [df.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        sizes = held[0].groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        row = sizes.agg(F.max("n").alias("fullest"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("filled")).first()
        if row.total and row.fullest > 2 * row.total / cores:
            spread = held[0].repartition(max(cores, row.filled)).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(spread)
            spread.count()
            held[0].unpersist()
        yield held[-1]
    finally:
        for frame in held:
            frame.unpersist()
