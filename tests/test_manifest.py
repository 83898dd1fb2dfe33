"""Manifests under runs that overlap, repeat or die."""

import os

import pytest
from pyspark.sql import functions as F

from tidemill.plans.shared import create_once, file_system
from tidemill.sources.sinks import Manifest

SCHEMA = "path string, label string"


def entries(spark, *paths):
    return spark.createDataFrame([(p, p and p[0]) for p in paths], SCHEMA)


def linked(manifest, version=None):
    return sorted((r.path for r in manifest.read(version).collect()), key=str)


def test_repeated_appends_add_nothing_and_versions_stay(spark, fresh):
    manifest = Manifest(spark, fresh("manifest"), "path", SCHEMA)
    assert manifest.version() == 0 and linked(manifest) == []
    assert manifest.append(entries(spark, "a", "b", "b", None, None)) == 1
    assert manifest.append(entries(spark, "b", "c", None)) == 2
    assert linked(manifest) == sorted(["a", "b", None, "c"], key=str) and linked(manifest, 1) == sorted(["a", "b", None], key=str)
    assert manifest.append(entries(spark, "a", "c")) == 3 and len(linked(manifest)) == 4


def test_interleaved_runs_add_each_key_once(spark, fresh):
    path = fresh("manifest")
    one, two, three = (Manifest(spark, path, "path", SCHEMA) for _ in range(3))
    one.append(entries(spark, "a"))
    first, second, third = one.prepare(entries(spark, "a", "b", "c")), two.prepare(entries(spark, "b", "c", "d")), three.prepare(entries(spark, "c", "e"))
    assert linked(one) == ["a"]  # nothing shows before its commit
    assert two.commit(*second) == 2 and one.commit(*first) == 3 and three.commit(*third) == 4
    assert linked(three) == ["a", "b", "c", "d", "e"]


def test_a_run_that_dies_before_its_commit_leaves_nothing(spark, fresh):
    manifest = Manifest(spark, fresh("manifest"), "path", SCHEMA)
    manifest.append(entries(spark, "a"))
    manifest.prepare(entries(spark, "b"))
    with pytest.raises(Exception):
        manifest.append(entries(spark, "c").withColumn("label", F.raise_error(F.lit("lost")).cast("string")))
    assert linked(manifest) == ["a"] and manifest.version() == 1
    assert manifest.append(entries(spark, "b", "c")) == 2 and linked(manifest) == ["a", "b", "c"]


def test_a_file_is_created_once_and_whole(fresh):
    folder = fresh("folder")
    os.makedirs(folder)
    files, base = file_system(f"file://{folder}")
    assert create_once(files, f"{base}/x", b"one") and not create_once(files, f"{base}/x", b"two")
    assert open(f"{folder}/x", "rb").read() == b"one" and os.listdir(folder) == ["x"]
