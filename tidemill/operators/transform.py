"""Column and array transforms.

Statistics are one-row frames used as scalar subqueries: computed once, then
applied in a projection, so the data is neither joined nor shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.arrays import argmax_index, to_rows
from tidemill.functions.hashing import as_list
from tidemill.plans.lookup import small_join


def select_xy(df: DataFrame, features, target: str, keep=()) -> DataFrame:
    """Feature columns as one vector ``x``, the target as ``y``."""
    vector = F.array(*[F.col(c).cast("double") for c in as_list(features)])
    return df.select(*as_list(keep), vector.alias("x"), F.col(target).alias("y"))


def log_target(df: DataFrame, col: str, out: str = "log_y") -> DataFrame:
    """Natural log; rows without one (value <= 0) are filtered out, at the scan if possible."""
    return df.where(F.col(col) > 0).withColumn(out, F.ln(F.col(col)))


def center(df: DataFrame, cols, by: str | None = None, suffix: str = "_centered") -> DataFrame:
    """Subtract the mean of the table, or of each ``by`` group."""
    cols = as_list(cols)
    if by is None:
        means = df.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct(*cols)).scalar()
        return df.withColumn("_m", means).withColumns({f"{c}{suffix}": F.col(c) - F.col(f"_m.{c}") for c in cols}).drop("_m")
    means = df.groupBy(by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    joined = small_join(df, means, by, "left")
    return joined.withColumns({f"{c}{suffix}": F.col(c) - F.col(f"_m_{c}") for c in cols}).drop(*[f"_m_{c}" for c in cols])


def rescale(df: DataFrame, col: str, divisor: float = 255.0, out: str | None = None) -> DataFrame:
    """Divide a number or every element of an array by a constant."""
    is_array = df.schema[col].dataType.typeName() == "array"
    scaled = F.transform(col, lambda x: x / F.lit(divisor)) if is_array else F.col(col) / F.lit(divisor)
    return df.withColumn(out or col, scaled)


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """One row: mean and population deviation per column.  Give it the training rows only."""
    cols = as_list(cols)
    return df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in cols])


def apply_scaler(df: DataFrame, stats: DataFrame, cols, suffix: str = "_std") -> DataFrame:
    """Standardise with fitted statistics; a constant column is only centred."""
    cols = as_list(cols)

    def scaled(c: str):
        std = F.col(f"_s.{c}.std")
        return (F.col(c) - F.col(f"_s.{c}.mean")) / F.when(std == 0, 1.0).otherwise(std)

    with_stats = df.withColumn("_s", stats.select(F.struct(*cols)).scalar())
    return with_stats.withColumns({f"{c}{suffix}": scaled(c) for c in cols}).drop("_s")


def fit_array_scaler(df: DataFrame, col: str) -> DataFrame:
    """One row: mean and population deviation of every position, as two arrays.

    The array is taken apart before a map-side combined aggregate, so the
    shuffle carries one row per position and task.
    """
    positions = df.select(F.posexplode(col).alias("pos", "v")).groupBy("pos")
    stats = positions.agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    ordered = stats.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("s"))
    return ordered.select(F.col("s.mean").alias("mean"), F.col("s.std").alias("std"))


def apply_array_scaler(df: DataFrame, stats: DataFrame, col: str, out: str | None = None) -> DataFrame:
    fitted = stats.select(
        F.struct("mean", F.transform("std", lambda s: F.when(s == 0, 1.0).otherwise(s)).alias("std"))
    ).scalar()
    centred = F.zip_with(F.col(col), F.col("_s.mean"), lambda x, m: x - m)
    scaled = F.zip_with(centred, F.col("_s.std"), lambda x, s: x / s)
    return df.withColumn("_s", fitted).withColumn(out or col, scaled).drop("_s")


def flatten_rows(df: DataFrame, col: str = "pixels", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, F.flatten(col))


def reshape(df: DataFrame, height: int, width: int, col: str = "pixels", out: str | None = None) -> DataFrame:
    """Flat array to ``height`` rows of ``width`` values."""
    return df.withColumn(out or col, to_rows(F.col(col), height, width))


def argmax_class(df: DataFrame, probs: str = "probs", out: str = "y_pred") -> DataFrame:
    return df.withColumn(out, argmax_index(F.col(probs)))


def channel_means(df: DataFrame, channels: int, col: str = "pixels") -> DataFrame:
    """Mean pixel value per channel of channel-last images."""
    exploded = df.select(F.posexplode(col).alias("pos", "v"))
    return exploded.groupBy((F.col("pos") % channels).alias("channel")).agg(F.avg("v").alias("mean"))


def normalize_channels(df: DataFrame, mode: str, channels: int = 3, means: DataFrame | None = None, col: str = "pixels", out: str | None = None) -> DataFrame:
    """``subtract_mean``: minus the channel's mean; ``unit_range``: [0, 255] to [-1, 1]."""
    if mode == "unit_range":
        return df.withColumn(out or col, F.transform(col, lambda x: x / F.lit(127.5) - 1.0))
    if mode != "subtract_mean" or means is None:
        raise ValueError("mode is 'unit_range', or 'subtract_mean' with a frame of channel means")
    ordered = means.agg(F.array_sort(F.collect_list(F.struct("channel", "mean"))).alias("m")).select("m.mean")
    shifted = F.transform(col, lambda x, i: x - F.element_at("_m", i % channels + 1))
    return df.withColumn("_m", ordered.scalar()).withColumn(out or col, shifted).drop("_m")


def resize_images(df: DataFrame, height, width, channels: int, new_height: int, new_width: int, col: str = "pixels", out: str | None = None) -> DataFrame:
    """Nearest-neighbour resize of flat channel-last images; the old size may differ by row (columns).

    Each old size of a batch gives one index vector, and a batch is one gather.
    A NULL image or size gives NULL; an image of another length than its size
    says is an error.
    """
    name = out or col
    sized = df.withColumns({f"_{n}": (v if isinstance(v, Column) else F.lit(v)).cast("int") for n, v in (("height", height), ("width", width))})
    schema = T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, df.schema[col].dataType)])
    others = [f.name for f in schema.fields[:-1]]

    def source(h: int, w: int) -> np.ndarray:
        row, column = np.arange(new_height) * h // new_height, np.arange(new_width) * w // new_width
        return ((row[:, None] * w + column)[..., None] * channels + np.arange(channels)).ravel()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images, sizes = batch.column(col), list(zip(batch.column("_height").to_pylist(), batch.column("_width").to_pylist()))
            lengths = images.value_lengths().to_pylist()
            present = np.array([n is not None and None not in s for n, s in zip(lengths, sizes)], dtype=bool)
            wrong = [(s, n) for s, n, p in zip(sizes, lengths, present) if p and s[0] * s[1] * channels != n]
            if wrong:
                raise ValueError(f"an image of {wrong[0][1]} values is not {wrong[0][0]} x {channels}")
            index = {s: source(*s) for s, p in zip(sizes, present) if p for s in [s]}
            starts = np.cumsum([0, *[n or 0 for n in lengths]])
            picks = [starts[i] + index[sizes[i]] for i in np.flatnonzero(present)]
            values = images.flatten().take(pa.array(np.concatenate(picks))) if picks else pa.array([], images.type.value_type)
            offsets = pa.array(np.r_[0, np.cumsum(present)].astype(np.int32) * (new_height * new_width * channels))
            resized = pa.ListArray.from_arrays(offsets, values, mask=pa.array(~present))
            yield pa.RecordBatch.from_arrays([*[batch.column(o) for o in others], resized], names=schema.names)

    return sized.mapInArrow(gather, schema)
