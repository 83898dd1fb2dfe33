"""Readers: headerless numeric CSV, class-per-folder trees, decoded images, array tables."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_numeric_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Headerless CSV with declared types; a malformed line stops the read."""
    return spark.read.schema(schema).csv(path, header=False, mode="FAILFAST")


def path_part(path: Column, from_end: int) -> Column:
    """Folder name counted from the end of a path: 1 is the file, 2 its parent."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def with_path_labels(df: DataFrame, path: str = "path") -> DataFrame:
    """Class = parent folder, split = grandparent."""
    return df.withColumn("split", path_part(F.col(path), 3)).withColumn("label", path_part(F.col(path), 2))


def read_labeled_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``path, split, label, length, content`` of ``<root>/<split>/<class>/<file>``.

    Leave ``content`` out of the selection and no file is opened.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    )
    return with_path_labels(files).select("path", "split", "label", "length", "content")


IMAGE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("split", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("decoded", T.BooleanType()),
    T.StructField("pixels", T.ArrayType(T.FloatType())),
])


def read_images(spark: SparkSession, root: str, glob: str = "*", rgb: bool = False) -> DataFrame:
    """Decoded images as flat height x width x channels arrays in R,G,B(,A) order.

    With ``rgb`` every image comes out with three channels: grey is repeated,
    transparency dropped.  A file that cannot be decoded stays, with ``decoded``
    false and sizes and pixels NULL.  Spark's image source decodes in the JVM
    (as B,G,R); its URL-encoded paths are brought to the form of a listing.
    """
    images = (
        spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).load(root)
        .select(
            F.regexp_replace(F.url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B"))), "^file:///", "file:/").alias("path"),
            *[F.when(F.col(f"image.{c}") > 0, F.col(f"image.{c}")).alias(c) for c in ("height", "width", "nChannels")], "image.data",
        )
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays, depths = [], []
            for data, channels in zip(batch.column("data"), batch.column("nChannels").to_pylist()):
                if channels is None:
                    arrays.append(None)
                    depths.append(None)
                    continue
                pixels = np.frombuffer(data.as_buffer(), dtype=np.uint8).astype(np.float32).reshape(-1, channels)
                if channels >= 3:
                    pixels = pixels[:, [2, 1, 0, *range(3, channels)]]
                if rgb:
                    pixels = np.repeat(pixels, 3, axis=1) if channels == 1 else pixels[:, :3]
                arrays.append(pixels.ravel())
                depths.append(pixels.shape[1])
            kept = [batch.column(n) for n in ("path", "split", "label", "height", "width")]
            columns = [*kept, pa.array(depths, pa.int32()), pa.array([d is not None for d in depths]), pa.array(arrays, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, names=IMAGE_SCHEMA.names)

    return with_path_labels(images).mapInArrow(decode, IMAGE_SCHEMA)


def read_array_table(spark: SparkSession, path: str, shape: tuple[int, ...], pixels: str = "pixels") -> DataFrame:
    """A table of equally shaped arrays, with ``shape_ok`` marking rows of the declared size."""
    return with_shape_check(spark.read.parquet(path), shape, pixels)


def with_shape_check(df: DataFrame, shape: tuple[int, ...], pixels: str = "pixels") -> DataFrame:
    return df.withColumn("shape_ok", F.coalesce(F.size(pixels) == int(np.prod(shape)), F.lit(False)))
