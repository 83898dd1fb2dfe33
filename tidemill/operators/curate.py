"""Class selection, listing, indexing and profiling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.functions.arrays import indicator
from tidemill.functions.hashing import as_list
from tidemill.plans.lookup import LOOKUP_ROWS, null_safe_join, pin_small, small_join
from tidemill.plans.ranking import ordered_row_number


def attach_names(df: DataFrame, dictionary: DataFrame, on: str = "class_index") -> DataFrame:
    """Add the names a dictionary gives to class or feature numbers."""
    return small_join(df, dictionary, on, "left")


def class_subset(df: DataFrame, classes, label: str = "label", limit: int = LOOKUP_ROWS) -> DataFrame:
    """Rows of the listed classes: a pushed-down filter for a list, a semi join for a table (behind a Bloom filter beyond ``limit`` rows)."""
    if isinstance(classes, DataFrame):
        return small_join(df, classes.select(F.col(classes.columns[0]).alias(label)), label, "left_semi", limit)
    return df.where(F.col(label).isin(list(classes)))


def missing_classes(df: DataFrame, classes: list, splits: list, split: str = "split", label: str = "label") -> DataFrame:
    """Requested (split, class) pairs without a single row."""
    present = df.where(F.col(label).isin(list(classes)) & F.col(split).isin(list(splits))).groupBy(split, label).agg(F.lit(1).alias("_seen"))
    wanted = (
        df.sparkSession.range(1)
        .select(F.explode(F.array(*[F.lit(s) for s in splits])).alias(split))
        .select(split, F.explode(F.array(*[F.lit(c) for c in classes])).alias(label))
    )
    # Both sides hold at most len(splits) * len(classes) rows.
    return wanted.join(F.broadcast(present), [split, label], "left_anti")


def link_once(df: DataFrame, manifest: DataFrame, key) -> DataFrame:
    """Mark each entry ``exists`` if the manifest or an earlier entry has its key, else ``linked``.

    NULL keys are equal to each other.  Appending only the ``linked`` rows
    makes repeated runs add nothing.  Both sides may be large: a shuffle join
    on the entry key, skew split by adaptive execution; repeats are numbered
    in a stream that holds one row at a time.
    """
    keys = as_list(key)
    known = manifest.select(*keys).distinct().withColumn("_known", F.lit(True))
    joined = null_safe_join(df, known, keys, "left")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*df.columns))) == 1
    return joined.withColumn("_first", first).withColumn("status", F.when(F.col("_first") & F.col("_known").isNull(), "linked").otherwise("exists")).drop("_known", "_first")


def append_links(marked: DataFrame, path: str) -> None:
    """Add the ``linked`` rows to a manifest folder."""
    marked.where(F.col("status") == "linked").drop("status").write.mode("append").parquet(path)


def split_listing(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Sorted classes of each split; the list grows with classes, not rows."""
    pairs = df.select(split, label).distinct()
    return pairs.groupBy(split).agg(F.array_sort(F.collect_list(label)).alias("classes"))


def class_count(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_classes"))


def class_index(df: DataFrame, label: str = "label") -> DataFrame:
    """Dictionary ``label, class_index``: 0..K-1 in ascending name order."""
    names = df.select(label).where(F.col(label).isNotNull()).distinct()
    pinned = pin_small(names)
    if pinned is None:
        ranked = ordered_row_number(names, label, "_rank")
    else:
        # Class names only, measured: one task may sort them.
        ranked = pinned.withColumn("_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(label)))
    return ranked.select(label, (F.col("_rank") - 1).cast("int").alias("class_index"))


def with_class_index(df: DataFrame, label: str = "label") -> DataFrame:
    return small_join(df, class_index(df, label), label, "left")


def sample_counts(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows per split and class, per split, and in total; ``level`` is 0, 1 and 3, which tells a total from a missing label."""
    # Counting first keeps the rollup's threefold expansion off the data.
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.rollup(split, label).agg(F.sum("n").alias("n"), F.grouping_id().cast("int").alias("level"))


def one_hot(df: DataFrame, label: str, k: int, out: str = "one_hot") -> DataFrame:
    return df.withColumn(out, indicator(F.col(label), k))


def profile(df: DataFrame, cols: list[str], divisor: float = 255.0) -> DataFrame:
    """Row count, array lengths and value range before and after scaling, per array column, in one pass."""
    stats = []
    for c in cols:
        stats += [
            F.count(c).alias(f"{c}__n"), F.min(F.size(c)).alias(f"{c}__short"), F.max(F.size(c)).alias(f"{c}__long"),
            F.min(F.array_min(c)).cast("double").alias(f"{c}__lo"), F.max(F.array_max(c)).cast("double").alias(f"{c}__hi"),
        ]
    per_column = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"{c}__n").alias("n_rows"), F.col(f"{c}__short").alias("min_length"),
            F.col(f"{c}__long").alias("max_length"), F.col(f"{c}__lo").alias("min_value"), F.col(f"{c}__hi").alias("max_value"),
            (F.col(f"{c}__lo") / divisor).alias("min_scaled"), (F.col(f"{c}__hi") / divisor).alias("max_scaled"),
        )
        for c in cols
    ]
    return df.agg(*stats).select(F.inline(F.array(*per_column)))
