"""Bloom filters before shuffle joins, and tables compared by bucket digests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import curate
from tidemill.operators.evaluate import bucket_digests, reconcile
from tidemill.plans import bloom
from tidemill.plans.lookup import small_join


def test_a_filter_misses_no_key_and_lets_few_others_through(spark):
    keys = spark.range(20_000).select((F.col("id") * 3).alias("k")).repartition(5)
    built = bloom.build(keys, "k")
    kept = {r.k for r in built.keep(spark.range(60_000).select(F.col("id").alias("k")), "k").collect()}
    assert set(range(0, 60_000, 3)) <= kept
    measured = (len(kept) - 20_000) / 40_000
    assert measured < 0.01 and abs(measured - built.rate) < 0.005


def test_missing_keys_are_keys_and_an_empty_filter_lets_nothing_through(spark):
    keys = spark.createDataFrame([("a", None), (None, 1), ("a", None)], "s string, n int")
    rows = spark.createDataFrame([("a", None), (None, None), (None, 1), ("b", 1)], "s string, n int")
    kept = {tuple(r) for r in bloom.build(keys, ["s", "n"]).keep(rows, ["s", "n"]).collect()}
    assert kept == {("a", None), (None, 1)}
    assert bloom.build(keys.limit(0), ["s", "n"]).keep(rows, ["s", "n"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left_semi", "left"])
def test_joins_give_the_same_with_and_without_a_filter(spark, how):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 50).alias("k"), "id")
    small = spark.createDataFrame([(3, "x"), (None, "y"), (77, "z")], "k long, v string")
    small = small.select("k") if how == "left_semi" else small
    a, b = (sorted(map(tuple, small_join(df, small, "k", how, limit=n).collect()), key=str) for n in (100, 0))
    assert a == b and len(a) >= 100


def test_keys_of_other_types_go_without_a_filter(spark):
    df, small = spark.range(100).select(F.col("id").cast("int").alias("k")), spark.range(5).select(F.col("id").alias("k"))
    assert sorted(r.k for r in small_join(df, small, "k", "left_semi", limit=0).collect()) == list(range(5))


def test_few_rows_reach_the_shuffle(spark, fresh):
    df = spark.range(50_000).select((F.col("id") % 5000).alias("label"), "id")
    df.write.parquet(path := fresh("rows"))
    wanted = spark.range(40).select((F.col("id") * 125).alias("label"))
    built = bloom.build(wanted, "label")
    assert built.keep(spark.read.parquet(path), "label").count() < 1.05 * 400
    assert curate.class_subset(spark.read.parquet(path), wanted, limit=0).count() == 400


def table(spark, n=3000):
    return spark.range(n).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 0.5).alias("x"), F.when(F.col("id") % 5 > 0, F.array(F.col("id"), F.lit(None).cast("long"))).alias("a"), F.lit(None).cast("string").alias("s"))


def test_planted_differences_are_all_named(spark):
    truth = table(spark)
    pred = truth.where("id <> 17").withColumn("s", F.when(F.col("id") == 40, "")).withColumn("a", F.when(F.col("id") == 41, F.array("id")).otherwise(F.col("a")))
    pred = pred.unionByName(truth.where("id IN (99, 100)")).unionByName(truth.where("id = 5").withColumn("id", F.lit(-1).cast("long")))
    got = sorted((r.id, r.s, r.n_truth, r.n_pred) for r in reconcile(truth, pred.repartition(3), "id").collect() if r.id not in (40, 41))
    assert got == [(-1, None, 0, 1), (17, None, 1, 0), (99, None, 1, 2), (100, None, 1, 2)]
    both = [(r.id, r.n_truth, r.n_pred) for r in reconcile(truth, pred, "id").where("id IN (40, 41)").collect()]
    assert sorted(both) == [(40, 0, 1), (40, 1, 0), (41, 0, 1), (41, 1, 0)]


def test_equal_tables_send_no_row_and_missing_columns_are_refused(spark):
    truth = table(spark)
    assert reconcile(truth, truth.repartition(7).select(*reversed(truth.columns)), "id").count() == 0
    assert bucket_digests(truth, "id", 8).count() == 8
    with pytest.raises(ValueError, match="columns differ"):
        reconcile(truth, truth.drop("s"), "id")
