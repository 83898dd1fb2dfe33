"""CSV, labelled file trees, decoded images, partitioned datasets and streams."""

import os
import struct
import subprocess
import sys
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators.augment import map_images
from tidemill.operators.evaluate import confusion_counts
from tidemill.operators.lifecycle import classify_folders
from tidemill.plans.scratch import scratch_dir
from tidemill.sources import files, sinks
from tidemill.streaming.confusion import run_to_end, stream_confusion, stream_table


def write_png(path, image):
    """An 8-bit PNG of an (h, w) or (h, w, 3) array."""
    h, w = image.shape[:2]
    raw = b"".join(b"\0" + image[r].astype("uint8").tobytes() for r in range(h))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture
def tree(tmp_path):
    rng = np.random.default_rng(5)
    truth = {}
    for split in ("Training", "Test"):
        for name in ("Kiwi 1", "Apple+Golden 1"):
            folder = tmp_path / "tree" / split / name
            folder.mkdir(parents=True)
            for i in range(3):
                image = rng.integers(0, 256, (4, 4, 3))
                write_png(folder / f"{i} x.png", image)
                truth[split, name, f"{i} x.png"] = image
    (tmp_path / "tree" / "Test" / "Kiwi 1" / "broken.png").write_bytes(b"not a png")
    return str(tmp_path / "tree"), truth


def test_labelled_files(spark, tree):
    root, truth = tree
    rows = files.read_labeled_files(spark, root, "*.png").select("path", "split", "label", "length").collect()
    assert len(rows) == 13
    assert {(r.split, r.label) for r in rows} == {(s, c) for s, c, _ in truth}
    listing = files.read_labeled_files(spark, root).select("path", "label")
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_images_decode_to_rgb_and_keep_their_names(spark, tree):
    root, truth = tree
    images = files.read_images(spark, root, "*.png")
    broken = images.where("not decoded").collect()
    assert [(r.height, r.width, r.channels, r.pixels) for r in broken] == [(None, None, None, None)]
    rows = images.where("decoded").collect()
    assert len(rows) == 12
    for r in rows:
        expected = truth[r.split, r.label, os.path.basename(r.path)]
        assert (r.height, r.width, r.channels) == (4, 4, 3)
        assert np.array_equal(np.array(r.pixels).reshape(4, 4, 3), expected)


def test_image_job_on_decoded_files(spark, tree):
    root, truth = tree
    scaled = map_images(files.read_images(spark, root, "*.png").select("path", "label", "pixels"), lambda x: x / 255.0)
    assert scaled.agg(F.max(F.array_max("pixels"))).first()[0] <= 1.0
    assert scaled.where("pixels is null").count() == 1


def test_listing_and_images_agree_on_paths(spark, tree):
    root, _ = tree
    listed = {r.path for r in files.read_labeled_files(spark, root, "*.png").select("path").collect()}
    decoded = {r.path for r in files.read_images(spark, root, "*.png").collect()}
    assert decoded == listed


def test_folder_lifecycle_on_coloured_images(spark, tmp_path):
    """Reddish against greenish images, one class grey-scale: easy to tell apart."""
    rng = np.random.default_rng(2)
    for side, count in (("Training", 15), ("Test", 6)):
        for name, colour in (("Lemon 1", [200, 40, 40]), ("Mango 1", [40, 200, 40]), ("Plum 1", None)):
            folder = tmp_path / side / name
            folder.mkdir(parents=True)
            for i in range(count):
                noise = rng.integers(-20, 20, (6, 5, 3))
                image = np.full((6, 5), 30) + noise[:, :, 0].clip(0) if colour is None else np.array(colour) + noise
                write_png(folder / f"{i}.png", image)
    outcome = classify_folders(spark, str(tmp_path), 4, 4, variants=2, features=12)
    scores = {r.split: r for r in outcome.scores.collect()}
    assert {s: r.n for s, r in scores.items()} == {"train": 3 * 12 * 2, "validation": 9, "test": 18}
    assert scores["test"].accuracy > 0.9
    cells = outcome.confusion.collect()
    assert len(cells) == 9 and sum(r.n for r in cells) == 18
    assert {r.y_true_name for r in cells} == {"Lemon 1", "Mango 1", "Plum 1"}


def test_csv_types_and_failfast(spark, fresh):
    path = fresh("csv")
    spark.createDataFrame([("1971", "2300"), ("2018", "23600000000")], "a string, b string").coalesce(1).write.csv(path)
    rows = files.read_numeric_csv(spark, path, "year INT, transistors BIGINT").orderBy("year").collect()
    assert [(r.year, r.transistors) for r in rows] == [(1971, 2300), (2018, 23600000000)]
    with pytest.raises(Exception):
        files.read_numeric_csv(spark, path, "year INT, transistors INT").collect()


def test_array_table_shape(spark, fresh):
    path = fresh("arrays")
    spark.createDataFrame([(1, [0.0] * 4), (2, [0.0] * 3)], "id int, pixels array<float>").write.parquet(path)
    assert {r.id: r.shape_ok for r in files.read_array_table(spark, path, (2, 2)).collect()} == {1: True, 2: False}


def test_dataset_prunes_partitions(spark, fresh):
    path = fresh("dataset")
    df = spark.range(100).select("id", F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"), (F.col("id") % 3).cast("string").alias("label"))
    sinks.write_dataset(df, path)
    back = sinks.read_dataset(spark, path)
    assert sorted(r.id for r in back.collect()) == list(range(100))
    plan = back.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_scratch_needs_the_setting_on_a_cluster(spark):
    def session(master, **settings):
        """A session like Spark's: the setting is static, so setting it raises."""
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master, applicationId=f"{master}-app"))

    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert scratch_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"}), "x").startswith("hdfs:///shared/x-")
    one, two = (scratch_dir(session("local[2]"), "x").split("/x-") for _ in range(2))
    assert one[0] == two[0] and one[1] != two[1]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "x")


def test_scratch_of_a_local_session_without_the_setting():
    code = (
        "from tidemill.session import local_session\nfrom tidemill.plans.scratch import scratch_dir\n"
        "s = local_session(1, '1g', 1)\nassert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "p = scratch_dir(s, 'x')\ns.range(3).write.parquet(p)\nassert s.read.parquet(p).count() == 3 and scratch_dir(s, 'x') != p\ns.stop()"
    )
    empty = {**os.environ, "SPARK_CONF_DIR": "/nonexistent", "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=empty, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_streamed_counts_equal_batch_counts_and_resume(spark, sf_dir, fresh):
    folder, checkpoint = fresh("events"), fresh("checkpoint")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("y_true"), F.when(F.col("value") < 30, "click").otherwise("view").alias("y_pred"))
    events.repartition(5).write.parquet(folder)

    def stream():
        return stream_confusion(stream_table(spark, folder, events.schema))

    first = {tuple(r) for r in run_to_end(stream(), checkpoint).collect()}
    assert first == {tuple(r) for r in confusion_counts(events).collect()}
    events.limit(10).coalesce(1).write.mode("append").parquet(folder)
    total = sum(r.n for r in run_to_end(stream(), checkpoint).collect())
    assert total == events.count() + 10
