"""Array files: headers, byte ranges, pruning, and what tasks write."""

import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.sources import arrays


def packaged(folder, n=23):
    """Images as NPY and labels as IDX, the way datasets come."""
    os.makedirs(folder, exist_ok=True)
    images = (np.arange(n * 12) % 251).astype(np.uint8).reshape(n, 3, 4)
    labels = (np.arange(n) % 10).astype(np.uint8)
    np.save(f"{folder}/images.npy", images)
    with open(f"{folder}/labels.idx", "wb") as f:
        f.write(bytes([0, 0, 8, 1]) + struct.pack(">I", n) + labels.tobytes())
    return images, labels, {"pixels": f"{folder}/images.npy", "label": f"{folder}/labels.idx"}


def test_named_files_are_read_in_aligned_ranges(spark, fresh):
    images, labels, paths = packaged(fresh("arrays"))
    df = arrays.read_array_files(spark, arrays=paths, split_bytes=60)
    assert df.rdd.getNumPartitions() == 5  # 5 rows of 12 bytes each
    rows = df.orderBy("row").collect()
    assert [r.row for r in rows] == list(range(23)) and [r.label for r in rows] == labels.tolist()
    assert np.array_equal(np.array([r.pixels for r in rows]), images.reshape(23, 12))


def test_a_narrower_schema_leaves_the_other_files_alone(spark, fresh):
    _, labels, paths = packaged(fresh("arrays"))
    slim = arrays.read_array_files(spark, arrays=paths, columns=["label", "row"], split_bytes=60)
    reader = arrays.ArrayReader({"arrays": json.dumps(paths), "split_bytes": "60"}, slim.schema)
    assert all(set(p.arrays) == {"label"} for p in reader.partitions())
    assert [r.label for r in slim.orderBy("row").collect()] == labels.tolist()
    with pytest.raises(Exception):
        arrays.read_array_files(spark, arrays=paths, columns=["colour"])


@pytest.mark.parametrize("values", [np.arange(6, dtype="<i8"), np.arange(6, dtype=">f4").reshape(3, 2), np.zeros((0, 5)), np.array([True, False]), np.arange(24, dtype="<u2").reshape(2, 3, 4)])
def test_headers_agree_with_numpy_both_ways(fresh, values):
    path = fresh("x") + ".npy"
    np.save(path, values)
    header = arrays.read_header(path)
    assert (header.shape, np.dtype(header.dtype)) == (values.shape, values.dtype)
    with open(path, "wb") as f:
        f.write(arrays.npy(values))
    assert np.array_equal(np.load(path), values) and arrays.read_header(path).shape == values.shape


def test_bad_files_are_refused(fresh):
    path = fresh("x") + ".npy"
    for write in (lambda: np.save(path, np.asfortranarray(np.ones((2, 3)))), lambda: np.save(path, np.array(1.0)), lambda: open(path, "wb").write(b"text, no array")):
        write()
        with pytest.raises(ValueError):
            arrays.read_header(path)
    np.save(path, np.ones(9))
    with open(path, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="bytes"):
        arrays.read_header(path)


def test_written_by_tasks_read_back_appended_and_replaced(spark, fresh):
    path = fresh("dataset")
    df = spark.range(100).select("id", (F.col("id") % 7).cast("int").alias("label"), F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: (F.col("id") * 10 + i).cast("float")).alias("pixels"))
    arrays.write_array_files(df.repartition(3), path, split_bytes=400)
    assert sum(f.endswith(".pixels.npy") for f in os.listdir(path)) > 3
    want = {r.id: (r.label, tuple(r.pixels)) for r in df.collect()}
    back = arrays.read_array_files(spark, path)
    assert {r.id: (r.label, tuple(r.pixels)) for r in back.collect()} == want and sorted(r.row for r in back.collect()) == list(range(100))
    arrays.write_array_files(df.limit(5), path)
    assert arrays.read_array_files(spark, path, columns=["id"]).count() == 105
    arrays.write_array_files(df.limit(5), path, mode="overwrite")
    assert arrays.read_array_files(spark, path, columns=["label"]).count() == 5


def test_a_failed_write_leaves_the_dataset_as_it_was(spark, fresh):
    path = fresh("dataset")
    df = spark.range(10).select("id", F.col("id").cast("double").alias("x"))
    arrays.write_array_files(df, path)
    with pytest.raises(Exception):
        arrays.write_array_files(df.withColumn("x", F.when(F.col("id") != 9, F.col("x"))), path)
    assert arrays.read_array_files(spark, path).count() == 10
    with pytest.raises(Exception):
        arrays.write_array_files(df.withColumn("x", F.col("x").cast("string")), path)


def test_arrays_of_different_lengths_are_refused(spark, fresh):
    _, _, paths = packaged(fresh("arrays"))
    np.save(paths["pixels"], np.zeros((3, 2)))
    with pytest.raises(Exception, match="different lengths"):
        arrays.read_array_files(spark, arrays=paths).count()
