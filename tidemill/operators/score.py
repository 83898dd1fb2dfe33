"""Batch prediction over tables."""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import dense
from tidemill.functions.hashing import uniform
from tidemill.sources.synthetic import grid


def _vectors(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], features: str, out: str) -> DataFrame:
    """Append fn(features) as ARRAY<DOUBLE>, a whole Arrow batch at a time.

    A NULL vector gives NULL; vectors of unequal length or with missing values
    are an error, never cut anew.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(features)
            present = column.is_valid().to_numpy(zero_copy_only=False)
            if present.any():
                result = np.ascontiguousarray(fn(dense.matrix(column.drop_null())), dtype=np.float64)
            else:
                result = np.zeros((0, 0))
            offsets = pa.array(np.r_[0, np.cumsum(present)].astype(np.int32) * result.shape[1])
            vectors = pa.ListArray.from_arrays(offsets, pa.array(result.ravel()), mask=pa.array(~present))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors], names=schema.names)

    return df.mapInArrow(run, schema)


def score_dense(df: DataFrame, layers: dense.Layers, features: str, output: str = "softmax", out: str = "probs") -> DataFrame:
    """Network output for every row; select the columns you need beforehand."""
    return _vectors(df, lambda x: dense.predict(layers, x, output), features, out)


def seeded_projection(dim_in: int, dim_out: int, seed: int) -> np.ndarray:
    """Fixed weights in [-1, 1) from the same md5 uniforms the tables use, drawn on the cluster."""
    drawn = SparkSession.active().range(dim_in * dim_out).select("id", (uniform(seed, "id") * 2.0 - 1.0).alias("w")).toArrow()
    weights = np.empty(dim_in * dim_out)
    weights[drawn.column("id").to_numpy()] = drawn.column("w").to_numpy()
    return weights.reshape(dim_in, dim_out)


def extract_features(df: DataFrame, features: str, dim_in: int, dim_out: int, seed: int = 42, fn: Callable | None = None, out: str = "frozen") -> DataFrame:
    """Frozen-backbone features, computed once and kept as a table for every head.

    ``fn`` maps (n, dim_in) to (n, dim_out); the default is a seeded projection
    with ReLU.
    """
    if fn is None:
        weights = seeded_projection(dim_in, dim_out, seed)
        fn = lambda x: np.maximum(x @ weights, 0.0)
    return _vectors(df, fn, features, out)


def predict_points(points: DataFrame, layers: dense.Layers, train_lo: float, train_hi: float, output: str = "linear") -> DataFrame:
    """``y_hat`` for points (x1, x2) and whether they lie outside the training square."""
    scored = score_dense(points.withColumn("_x", F.array("x1", "x2")), layers, "_x", output, "_out")
    outside = F.greatest(F.abs(F.col("x1") - (train_lo + train_hi) / 2), F.abs(F.col("x2") - (train_lo + train_hi) / 2)) > (train_hi - train_lo) / 2
    return scored.withColumn("y_hat", F.col("_out")[0]).withColumn("extrapolated", outside).drop("_x", "_out")


def predict_surface(spark: SparkSession, layers: dense.Layers, lo: float, hi: float, steps: int, train_lo: float = -3.0, train_hi: float = 3.0) -> DataFrame:
    """Predictions on a grid, inside or beyond the training range."""
    return predict_points(grid(spark, lo, hi, steps), layers, train_lo, train_hi)


def extrapolation_error(df: DataFrame, y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """Mean squared error inside and outside the training range."""
    error = F.col(y) - F.col(y_hat)
    return df.groupBy("extrapolated").agg(F.avg(error * error).alias("mse"), F.count(F.lit(1)).alias("n"))


def append_predictions(parts: list[DataFrame]) -> DataFrame:
    """Predictions of several batches as one table, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)
