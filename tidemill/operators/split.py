"""Reproducible splits, orders and mini-batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import as_list, uniform_below
from tidemill.plans.lookup import small_join
from tidemill.plans.permute import Permutation
from tidemill.plans.ranking import first_cut, group_cut, hash_cut, hash_row_number

#: A top-k sends so many rows of every task to one task; beyond, a cut value is found first.
TOP_K_ROWS = 1_000


def check_unique(df: DataFrame, key) -> None:
    """Raise if the columns that exact splits and ranks order by do not identify a row.

    A map-side combined count: a key that repeats often is one row per task.
    """
    keys = as_list(key)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).first()
    if repeated is not None:
        raise ValueError(f"{keys} do not identify a row: {repeated.asDict()}")


def hash_split(df: DataFrame, key, fraction: float, seed=42, names=("train", "validation"), out: str = "split") -> DataFrame:
    """Approximate split: a row's side depends only on its key.  No shuffle."""
    held_out = uniform_below(fraction, seed, *as_list(key))
    return df.withColumn(out, F.when(held_out, names[1]).otherwise(names[0]))


def exact_split(df: DataFrame, key, fraction: float, seed=42, names=("train", "test"), out: str = "split") -> DataFrame:
    """Split with exactly ceil(n * fraction) rows on the second side.  No shuffle of the data."""
    flagged = hash_cut(df, key, fraction, seed, "_held_out")
    return flagged.withColumn(out, F.when(F.col("_held_out"), names[1]).otherwise(names[0])).drop("_held_out")


def class_cuts(df: DataFrame, key: str, fraction: float, label: str = "label") -> DataFrame:
    """Per class, the key of the last validation row: rank floor(n * fraction) in key order."""
    return group_cut(df, label, key, F.floor(F.col("total") * F.lit(float(fraction))))


def apply_class_cuts(df: DataFrame, cuts: DataFrame, key: str, label: str = "label", names=("train", "validation"), out: str = "split") -> DataFrame:
    joined = small_join(df, cuts, label, "left")
    return joined.withColumn(out, F.when(F.col(key) <= F.col("cut"), names[1]).otherwise(names[0])).drop("cut")


def class_split(df: DataFrame, key: str, fraction: float, label: str = "label", names=("train", "validation"), out: str = "split") -> DataFrame:
    """Per class, the first floor(n * fraction) rows by key form the validation side.

    ``key`` (a file path, say) must be unique inside its class.  The data is
    compared with one cut value per class; a dominant class is no special case.
    For files, take the cuts from a listing and apply them to the content.
    """
    return apply_class_cuts(df, class_cuts(df, key, fraction, label), key, label, names, out)


def global_row_number(df: DataFrame, key, seed=0, out: str = "rank") -> DataFrame:
    """Dense 1..n ranks in digest order without a one-task sort."""
    return hash_row_number(df, key, seed, out)


def shuffle_epoch(df: DataFrame, key, seed, epoch: int, out: str = "position") -> DataFrame:
    """The sample order of one epoch: a new permutation per (seed, epoch)."""
    return hash_row_number(df, key, f"{seed}:{epoch}", out)


def epoch_order(ranked: DataFrame, n: int, seed, epoch: int, rank: str = "rank", out: str = "position") -> DataFrame:
    """Another sample order of rows that ``global_row_number`` ranked once: 1..n, a new permutation per (seed, epoch).

    A projection: further epochs shuffle nothing.  ``n`` is the number of
    ranks; keep the ranked table, or every epoch ranks again.
    """
    zero = ranked.withColumn("_zero", F.col(rank) - 1)
    return Permutation(n, f"{seed}:{epoch}").apply(zero, "_zero", out).withColumn(out, F.col(out) + 1).drop("_zero")


def epoch_batches(ranked: DataFrame, n: int, size: int, seed=42, epoch: int = 0, rank: str = "rank", drop_remainder: bool = True) -> DataFrame:
    """``batch_id`` and ``pos`` of ranked rows in an epoch's order: ``assign_batches`` without its shuffle."""
    placed = epoch_order(ranked, n, seed, epoch, rank, "_place").withColumn("_place", F.col("_place") - 1)
    if drop_remainder:
        placed = placed.where(F.col("_place") < n // size * size)
    batch_id = F.call_function("div", F.col("_place"), F.lit(size).cast("long"))
    return placed.withColumns({"batch_id": batch_id, "pos": (F.col("_place") % size).cast("int")}).drop("_place")


def assign_batches(df: DataFrame, key, size: int, seed=42, epoch: int = 0, drop_remainder: bool = True) -> DataFrame:
    """``batch_id`` and ``pos`` of every sample; the incomplete last batch is left out by default."""
    ranked = shuffle_epoch(df, key, seed, epoch, "_rank")
    zero = F.col("_rank") - 1
    batched = ranked.select("*", F.floor(zero / size).alias("batch_id"), (zero % size).cast("int").alias("pos")).drop("_rank")
    if not drop_remainder:
        return batched
    steps = df.agg(F.floor(F.count(F.lit(1)) / size)).scalar()
    return batched.where(F.col("batch_id") < steps)


def take_first(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows by a column, NULLs first; of equal values at the end any that make up n.

    A top-k for small n.  Beyond, rows below the cut value are taken by a
    filter and those at it up to n, so the values are the same either way.
    """
    if n <= TOP_K_ROWS:
        return df.orderBy(order).limit(n)
    c = F.col(order)
    missing = df.where(c.isNull()).count()
    if missing >= n:
        return df.where(c.isNull()).limit(n)
    cut = first_cut(df.where(c.isNotNull()), order, n - missing).first()
    if cut is None:
        return df
    below = df.where(c.isNull() | (c < F.lit(cut["cut"])))
    return below.unionByName(df.where(c == F.lit(cut["cut"])).limit(n - below.count()))
