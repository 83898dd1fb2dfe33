"""Generated samples and evaluation grids."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.hashing import uniform


def surface(x1: Column, x2: Column) -> Column:
    return F.cos(2 * x1) + F.cos(3 * x2)


def sample_points(keys: DataFrame, key: str, lo: float, hi: float, seed=0) -> DataFrame:
    """One point of [lo, hi)^2 with its surface value per key, the same on every run."""
    span = hi - lo
    points = keys.select(
        key,
        (lo + span * uniform(f"{seed}:x1", key)).alias("x1"),
        (lo + span * uniform(f"{seed}:x2", key)).alias("x2"),
    )
    return points.withColumn("y", surface(F.col("x1"), F.col("x2")))


def synth_samples(spark: SparkSession, n: int, lo: float, hi: float, seed=0) -> DataFrame:
    return sample_points(spark.range(n), "id", lo, hi, seed)


def grid_axis(index: Column, lo, hi, steps: int) -> Column:
    """index-th of ``steps`` evenly spaced values from lo to hi, both included."""
    return lo + (hi - lo) * index / F.lit(float(steps - 1))


def grid(spark: SparkSession, lo: float, hi: float, steps: int) -> DataFrame:
    """steps x steps points of [lo, hi]^2, x1 varying fastest.

    The point number alone gives both coordinates, so no join is needed.
    """
    points = spark.range(steps * steps)
    return points.select(
        "id",
        grid_axis(F.col("id") % steps, F.lit(float(lo)), F.lit(float(hi)), steps).alias("x1"),
        grid_axis(F.floor(F.col("id") / steps), F.lit(float(lo)), F.lit(float(hi)), steps).alias("x2"),
    )
