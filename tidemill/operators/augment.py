"""Augmentation as a reproducible dataset job."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.arrays import let, moved
from tidemill.functions.hashing import as_list, digest, uniform_part

RANGES = {"rotation": 20.0, "shift": 0.1, "shear": 0.1, "zoom": 0.2}


def augment_plan(df: DataFrame, key: str, variants: int, ranges: dict | None = None, seed=42, split: str | None = None) -> DataFrame:
    """Fan each training sample out to ``variants`` rows with drawn parameters.

    With ``split`` given, rows of other splits come out once and unchanged.
    Angles and shear are degrees, shifts are shares of height and width.
    """
    training = F.lit(True) if split is None else F.coalesce(F.col(split) == "train", F.lit(False))
    last = F.when(training, variants - 1).otherwise(0)
    fanned = df.withColumn("variant", F.explode(F.sequence(F.lit(0), last)))
    return with_draws(fanned, key, F.col("variant"), ranges, seed, training)


DRAWS = ["angle", "shift_y", "shift_x", "shear", "zoom_y", "zoom_x", "flip_h", "flip_v"]


def with_draws(df: DataFrame, key, variant: Column, ranges: dict | None = None, seed=42, training: Column | None = None) -> DataFrame:
    """One draw of all parameters per row, from (seed, key, variant); rows that are not ``training`` get those that change nothing."""
    r, keys = {**RANGES, **(ranges or {})}, as_list(key)
    training = F.lit(True) if training is None else training
    drawn = df.withColumn("_h1", digest(f"{seed}:geometry", *keys, variant)).withColumn("_h2", digest(f"{seed}:zoom", *keys, variant))

    def around_zero(column: str, part: int, span: float) -> Column:
        return F.when(training, (uniform_part(F.col(column), part) * 2.0 - 1.0) * span).otherwise(0.0)

    def coin(part: int) -> Column:
        return training & (uniform_part(F.col("_h2"), part) < 0.5)

    return drawn.withColumns({
        "angle": around_zero("_h1", 0, r["rotation"]),
        "shift_y": around_zero("_h1", 1, r["shift"]),
        "shift_x": around_zero("_h1", 2, r["shift"]),
        "shear": around_zero("_h1", 3, r["shear"]),
        "zoom_y": 1.0 + around_zero("_h2", 0, r["zoom"]),
        "zoom_x": 1.0 + around_zero("_h2", 1, r["zoom"]),
        "flip_h": coin(2),
        "flip_v": coin(3),
    }).drop("_h1", "_h2")


def flip(df: DataFrame, axis: str, col: str = "pixels", out: str | None = None) -> DataFrame:
    """Mirror images given as rows: ``horizontal`` swaps left and right."""
    mirrored = F.transform(col, lambda row: F.reverse(row)) if axis == "horizontal" else F.reverse(F.col(col))
    return df.withColumn(out or col, mirrored)


def shift(df: DataFrame, dx, dy, height: int, width: int, col: str = "pixels", out: str | None = None) -> DataFrame:
    """Move images given as rows by whole pixels (right and down), repeating the edge pixel."""
    dx = dx if isinstance(dx, Column) else F.lit(dx)
    dy = dy if isinstance(dy, Column) else F.lit(dy)
    rows = let(F.col(col), lambda image: moved(image, dy, height))
    return df.withColumn(out or col, F.transform(rows, lambda row: moved(row, dx, width)))


def warp_images(images: np.ndarray, draws: dict[str, np.ndarray]) -> np.ndarray:
    """(n, height, width, channels) images under one draw each: the nearest input pixel of every output pixel, edges repeated."""
    n, height, width, _ = images.shape
    rows, cols = np.meshgrid(np.arange(height) - (height - 1) / 2.0, np.arange(width) - (width - 1) / 2.0, indexing="ij")
    p = {name: draws[name][:, None, None] for name in DRAWS}
    turn, lean = np.deg2rad(p["angle"]), np.deg2rad(p["shear"])
    # Right to left: zoom, shear, shift, rotate.
    y = rows * p["zoom_y"] - np.sin(lean) * cols * p["zoom_x"] + p["shift_y"] * height
    x = np.cos(lean) * cols * p["zoom_x"] + p["shift_x"] * width
    src_y = np.cos(turn) * y - np.sin(turn) * x + (height - 1) / 2.0
    src_x = np.sin(turn) * y + np.cos(turn) * x + (width - 1) / 2.0
    iy = np.clip(np.floor(src_y + 0.5), 0, height - 1).astype(np.int64)
    ix = np.clip(np.floor(src_x + 0.5), 0, width - 1).astype(np.int64)
    warped = images[np.arange(n)[:, None, None], iy, ix]
    warped = np.where(p["flip_h"][..., None], warped[:, :, ::-1], warped)
    return np.where(p["flip_v"][..., None], warped[:, ::-1], warped)


def affine(df: DataFrame, height: int, width: int, channels: int, col: str = "pixels", out: str | None = None) -> DataFrame:
    """Apply the parameters of ``augment_plan`` to flat channel-last images.

    Each output pixel takes the nearest input pixel under rotation, shift,
    shear and zoom about the image centre; outside, the edge is repeated.
    A NULL image stays NULL; one of another size is an error.
    """
    name = out or col
    schema = T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, T.ArrayType(T.FloatType()))])
    others = [f.name for f in schema.fields[:-1]]

    def warp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = height * width * channels
            lengths = batch.column(col).value_lengths()
            present = lengths.is_valid().to_numpy(zero_copy_only=False)
            if set(lengths.drop_null().to_pylist()) - {size}:
                raise ValueError(f"an image is not {height} x {width} x {channels}")
            n = int(present.sum())
            images = batch.column(col).flatten().to_numpy(zero_copy_only=False).reshape(n, height, width, channels)
            warped = warp_images(images, {d: batch.column(d).to_numpy(zero_copy_only=False)[present] for d in DRAWS})
            offsets = pa.array(np.r_[0, np.cumsum(present)].astype(np.int32) * size)
            pixels = pa.ListArray.from_arrays(offsets, pa.array(warped.astype(np.float32).ravel()), mask=pa.array(~present))
            yield pa.RecordBatch.from_arrays([*[batch.column(o) for o in others], pixels], names=schema.names)

    return df.mapInArrow(warp, schema)


def map_images(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], col: str = "pixels", out: str | None = None) -> DataFrame:
    """Apply a user's function on a batch: (n, size) floats in, (n, any size) out.

    Images of one batch may differ in size; each size is passed separately.
    A NULL image stays NULL.
    """
    name = out or col
    schema = T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, T.ArrayType(T.FloatType()))])
    others = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(col)
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                picked = batch.filter(pa.array(sizes == size))
                if size < 0:
                    missing = pa.nulls(picked.num_rows, pa.list_(pa.float32()))
                    yield pa.RecordBatch.from_arrays([*[picked.column(o) for o in others], missing], names=schema.names)
                    continue
                values = picked.column(col).flatten().to_numpy(zero_copy_only=False).reshape(picked.num_rows, int(size))
                result = np.ascontiguousarray(fn(values), dtype=np.float32)
                offsets = pa.array(np.arange(picked.num_rows + 1, dtype=np.int32) * result.shape[1])
                pixels = pa.ListArray.from_arrays(offsets, pa.array(result.ravel()))
                yield pa.RecordBatch.from_arrays([*[picked.column(o) for o in others], pixels], names=schema.names)

    return df.mapInArrow(run, schema)
