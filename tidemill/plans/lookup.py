"""Joins against tables that are usually small, with the size measured first."""

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.bloom import build

LOOKUP_ROWS = 100_000
LOOKUP_BYTES = 64 * 1024 * 1024


def pin_small(small: DataFrame, limit: int = LOOKUP_ROWS) -> DataFrame | None:
    """The table as local rows if it has at most ``limit`` of them (and 64 MB), else None.

    Rows and bytes are added up on the cluster; nothing reaches the driver
    before they are known to be few.
    """
    width = F.octet_length(F.to_json(F.struct(*small.columns)))
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
        if rows > limit or size > LOOKUP_BYTES:
            return None
        return small.sparkSession.createDataFrame(small.toArrow(), small.schema)
    finally:
        small.unpersist()


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns in which NULL matches NULL; ``right``'s keys are not repeated."""
    keys = [on] if isinstance(on, str) else list(on)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def _same_hash(left: DataFrame, right: DataFrame, on) -> bool:
    """Whether equal keys have equal hashes: the types agree and have one form of each value."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return all(a[k] == b[k] and a[k] not in ("float", "double") for k in ([on] if isinstance(on, str) else on))


def small_join(df: DataFrame, small: DataFrame, on, how: str = "left", limit: int = LOOKUP_ROWS) -> DataFrame:
    """Null-safe join that broadcasts ``small`` when measured small and shuffles otherwise.

    The shuffle join is left to adaptive execution, which splits skewed keys.
    If only matching rows stay, a Bloom filter of ``small`` drops the others
    before they are shuffled.
    """
    pinned = pin_small(small, limit)
    if pinned is None and how in ("inner", "left_semi") and _same_hash(df, small, on):
        df = build(small, on).keep(df, on)
    return null_safe_join(df, small if pinned is None else F.broadcast(pinned), on, how)


def value_list(small: DataFrame, limit: int = LOOKUP_ROWS) -> list:
    """Sorted distinct values of a one-column table of bounded size, such as class names."""
    rows = small.distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a grid of more than {limit} x {limit} classes")
    return sorted(r[0] for r in rows)
