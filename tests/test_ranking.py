"""Ranks, cuts and splits: exact, complete, and independent of partitioning."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.operators import split
from tidemill.plans import ranking


def keyed(spark, n, partitions):
    return spark.range(n).select((F.col("id") * 7 % 100_003).alias("k"), F.lit("a").alias("g")).repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_hash_ranks_are_dense_and_stable(spark, partitions):
    rows = split.global_row_number(keyed(spark, 500, partitions), "k", seed=3).collect()
    expected = sorted((hashlib.md5(f"3:{r.k}".encode()).hexdigest(), r.k) for r in rows)
    assert [r.k for r in sorted(rows, key=lambda r: r.rank)] == [k for _, k in expected]
    assert sorted(r.rank for r in rows) == list(range(1, 501))


@pytest.mark.parametrize("n,fraction", [(0, 0.3), (1, 0.0), (1, 0.5), (1000, 0.33), (1000, 1.0), (1000, 0.0)])
def test_exact_split_has_the_exact_count(spark, n, fraction):
    rows = split.exact_split(keyed(spark, n, 4), "k", fraction).collect()
    assert len(rows) == n
    assert sum(r.split == "test" for r in rows) == math.ceil(n * fraction)


def test_exact_split_takes_the_first_in_digest_order(spark):
    frame = keyed(spark, 3000, 4)
    plain = frame.withColumn("r", F.row_number().over(Window.orderBy(F.md5(F.concat(F.lit("42:"), F.col("k"))), "k")))
    expected = {r.k for r in plain.where("r <= 990").collect()}
    assert {r.k for r in split.exact_split(frame, "k", 0.33).where("split = 'test'").collect()} == expected


def test_hash_split_is_close_and_ignores_partitioning(spark):
    one = {r.k: r.split for r in split.hash_split(keyed(spark, 5000, 1), "k", 0.2).collect()}
    many = {r.k: r.split for r in split.hash_split(keyed(spark, 5000, 16), "k", 0.2).collect()}
    assert one == many
    assert abs(sum(v == "validation" for v in one.values()) / 5000 - 0.2) < 0.03
    assert {r.split for r in split.hash_split(keyed(spark, 50, 1), "k", 1.0).collect()} == {"validation"}
    assert {r.split for r in split.hash_split(keyed(spark, 50, 1), "k", 0.0).collect()} == {"train"}


def skewed(spark, n=12_000):
    """One class with a third of all rows, many small ones, more rows than sampled bounds."""
    label = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 41 != 0, F.concat(F.lit("c"), F.col("id") % 40))
    return spark.range(n).select(F.format_string("f%07d", (F.col("id") * 7919) % 1_000_003).alias("path"), label.alias("label"))


@pytest.mark.parametrize("partitions", [1, 8])
def test_class_split_matches_a_plain_window_under_skew(spark, partitions):
    frame = skewed(spark).repartition(partitions)
    w = Window.partitionBy("label")
    plain = frame.withColumn("r", F.row_number().over(w.orderBy("path"))).withColumn("n", F.count("*").over(w))
    expected = {(r.label, r.path) for r in plain.where("r <= floor(n * 0.2D)").collect()}
    got = split.class_split(frame, "path", 0.2)
    assert {(r.label, r.path) for r in got.where("split = 'validation'").collect()} == expected
    assert got.count() == 12_000


def test_class_split_without_broadcast_gives_the_same(spark, monkeypatch):
    frame = skewed(spark, 3000)
    expected = {(r.path, r.split) for r in split.class_split(frame, "path", 0.2).collect()}
    monkeypatch.setattr("tidemill.plans.lookup.small_join.__defaults__", ("left", 3))
    assert {(r.path, r.split) for r in split.class_split(frame, "path", 0.2).collect()} == expected


def test_ordered_ranks_follow_the_value(spark):
    rows = ranking.ordered_row_number(skewed(spark), "path").collect()
    assert [r.path for r in sorted(rows, key=lambda r: r.rank)] == sorted(r.path for r in rows)
    assert [r.rank for r in sorted(rows, key=lambda r: r.rank)] == list(range(1, 12_001))


def test_take_first_large_equals_top_k(spark, monkeypatch):
    frame = skewed(spark)
    monkeypatch.setattr(split, "TOP_K_ROWS", 10_000)
    expected = {r.path for r in split.take_first(frame, "path", 5000).collect()}
    monkeypatch.setattr(split, "TOP_K_ROWS", 10)
    assert {r.path for r in split.take_first(frame, "path", 5000).collect()} == expected
    assert split.take_first(frame, "path", 50_000).count() == 12_000


def test_batches_are_full_and_drop_only_the_remainder(spark):
    rows = split.assign_batches(keyed(spark, 1003, 4), "k", 32).collect()
    assert len(rows) == 1003 // 32 * 32
    assert {(r.batch_id, r.pos) for r in rows} == {(b, p) for b in range(1003 // 32) for p in range(32)}
    assert split.assign_batches(keyed(spark, 1003, 4), "k", 32, drop_remainder=False).count() == 1003


def test_repeated_keys_are_reported(spark):
    frame = keyed(spark, 50, 4)
    split.check_unique(frame, "k")
    with pytest.raises(ValueError, match="do not identify a row"):
        split.check_unique(frame.unionByName(frame.limit(1)), ["k", "g"])


def test_epochs_differ(spark):
    a, b = ({r.k: r.position for r in split.shuffle_epoch(keyed(spark, 300, 4), "k", 1, e).collect()} for e in (0, 1))
    assert a != b and sorted(a.values()) == sorted(b.values())


@pytest.mark.parametrize("descending", [True, False])
def test_competition_rank_with_hot_group_and_ties(spark, descending):
    frame = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 13 != 0, F.concat(F.lit("e"), F.col("id") % 7)).alias("e"),
        F.when(F.col("id") % 2 == 0, 5.0).when(F.col("id") % 11 != 0, (F.col("id") % 997).cast("double")).alias("v"), "id")
    order = F.desc("v") if descending else F.asc("v")
    expected = {(r.id, r["r"]) for r in frame.withColumn("r", F.rank().over(Window.partitionBy("e").orderBy(order))).collect()}
    got = ranking.competition_rank(frame, "e", "v", "r", descending)
    assert {(r.id, r["r"]) for r in got.collect()} == expected


def test_no_data_sized_single_partition_exchange(spark, sf_dir):
    """The one-task exchanges hold bucket counts only: the ranked rows move by bucket."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    plan = split.global_row_number(orders, "o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_b" in plan
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "count(1)" in part.split("FileScan")[0]
    flagged = split.exact_split(orders, "o_orderkey", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in flagged.split("+- Subquery")[0].split(":- Subquery")[0]


def test_take_first_gives_the_same_values_either_way(spark, monkeypatch):
    frame = spark.range(6000).selectExpr("CASE WHEN id % 100 = 0 THEN NULL ELSE id % 1500 END AS v")
    monkeypatch.setattr(split, "TOP_K_ROWS", 10_000)
    want = [r.v for r in split.take_first(frame, "v", 5000).collect()]
    monkeypatch.setattr(split, "TOP_K_ROWS", 10)
    for n in (30, 5000, 7000):
        got = sorted((r.v for r in split.take_first(frame, "v", n).collect()), key=lambda v: (v is not None, v or 0))
        assert len(got) == min(n, 6000) and (n != 5000 or got == want)


def test_bounds_prefilter_keeps_every_rank(spark):
    """More rows than the digest threshold lets through, and more bounds than the least number."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("v"))
    try:
        for partitions in ("4", "1500"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert ranking.bound_count(frame) == (4095 if partitions == "4" else 8191)
            ranked = ranking.ordered_row_number(frame, "v")
            assert ranked.where("rank <> v + 1").count() == 0
            bounds = ranking._bounds(frame, "v", ["v"]).select(F.size("_a")).first()[0]
            assert bounds == ranking.bound_count(frame)
            assert split.exact_split(frame, "v", 0.33).where("split = 'test'").count() == 13_200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
