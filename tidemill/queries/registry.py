"""Registry of queries and helpers they share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines; adding zero turns -0.0 into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def per_position(df: DataFrame, keys: list[str], array: str, digits: int | None = None) -> DataFrame:
    """One row per array element: keys, pos, value."""
    long = df.select(*keys, F.posexplode(array).alias("pos", "_v"))
    value = F.col("_v").cast("double")
    return long.select(*keys, "pos", (value if digits is None else rounded(value, digits)).alias("value"))


def sql_u32(seed, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


def sql_round(expression: str, digits: int = 6) -> str:
    return f"(round({expression}, {digits}) + 0.0::DOUBLE)"


def sql_split(key: str, fraction: float, seed=42) -> str:
    return f"CASE WHEN {sql_u32(seed, key)} / 4294967296.0::DOUBLE < {fraction}::DOUBLE THEN 'validation' ELSE 'train' END"
