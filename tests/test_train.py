"""Fits: exact where a closed form or a replay exists, falling loss elsewhere."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.functions.optimizers import Optimizer
from tidemill.operators import train
from tidemill.operators.score import score_dense
from tidemill.operators.split import hash_split
from tidemill.operators.transform import argmax_class
from tidemill.plans.iterate import kept
from tidemill.sources.synthetic import synth_samples


@pytest.fixture(scope="module")
def line(spark):
    noise = (F.col("id") * 7919 % 101) / 101 - 0.5
    return spark.range(400).select("id", (F.col("id") % 20 - 10).cast("double").alias("x"), noise.alias("e")).select(
        "id", "x", (3.0 + 0.4 * F.col("x") + F.col("e")).alias("y"))


def test_descent_converges_to_the_least_squares_line(spark, line):
    exact = train.fit_line(line, "x", "y").first()
    state, history = train.fit_linear_gd(line, "x", "y", 60, steps=30, optimizer=Optimizer("sgd", 0.01, 0.9))
    assert np.allclose(state.weights, [exact.slope, exact.intercept], atol=1e-6)
    losses = [r.loss for r in history.orderBy("epoch").collect()]
    assert losses[0] > losses[-1]


def test_doubling_time_of_an_exact_doubling(spark):
    df = spark.range(10).select("id", F.pow(2.0, F.col("id") / 2).alias("y"))
    assert abs(train.doubling_time(df, "id", "y").first().doubling_time - 2.0) < 1e-9
    flat = spark.range(10).select("id", F.lit(3.0).alias("y"))
    assert train.doubling_time(flat, "id", "y").first().doubling_time is None


def replay(x, y, rule, epochs):
    w, slots = np.zeros(x.shape[1]), rule.slots(x.shape[1])
    for step in range(1, epochs + 1):
        p = 1 / (1 + np.exp(-x @ w))
        w, slots = rule.update(w, x.T @ (p - y) / len(y), slots, step, rule.lr)
    return w


@pytest.mark.parametrize("rule", [Optimizer("sgd", 0.1, 0.9), Optimizer("adam", 0.05), Optimizer("rmsprop", 0.02)])
def test_logistic_follows_a_plain_replay_and_resumes(spark, line, rule):
    df = line.withColumn("label", (F.col("y") > 3).cast("int"))
    rows = np.array([[r.x, 1.0, r.label] for r in df.collect()])
    state, history = train.fit_logistic(df, "x", "label", 5, rule)
    assert np.allclose(state.weights, replay(rows[:, :2], rows[:, 2], rule, 5))
    losses = [r.loss for r in history.orderBy("epoch").collect()]
    assert losses[-1] < losses[0]
    half, _ = train.fit_logistic(df, "x", "label", 2, rule)
    rest, _ = train.resume(train.fit_logistic, half, df, "x", "label", 3, rule)
    assert np.allclose(rest.weights, state.weights)


def test_logistic_skips_incomplete_rows_and_scores_validation(spark, line):
    df = hash_split(line.withColumn("label", (F.col("y") > 3).cast("int")), "id", 0.25)
    gaps = df.unionByName(df.limit(20).withColumn("x", F.lit(None).cast("double")))
    a, history = train.fit_logistic(df, "x", "label", 20, Optimizer("adam", 0.2), split="split")
    b, _ = train.fit_logistic(gaps, "x", "label", 20, Optimizer("adam", 0.2), split="split")
    assert np.allclose(a.weights, b.weights)
    last = history.orderBy(F.desc("epoch")).first()
    assert last.accuracy > 0.9 and last.val_accuracy > 0.9 and last.val_loss < 0.5


def test_state_round_trip(spark, fresh):
    state = train.FitState(np.arange(5.0), np.ones((2, 5)), 7, [4, 1], "sigmoid")
    path = fresh("state")
    train.save_state(spark, state, path)
    back = train.load_state(spark, path)
    assert np.array_equal(back.weights, state.weights) and np.array_equal(back.slots, state.slots)
    assert (back.step, back.widths, back.output) == (7, [4, 1], "sigmoid")


def blobs(spark, n=1200):
    rng = np.random.default_rng(3)
    label = np.arange(n) % 3
    x = np.array([[0, 3], [3, -2], [-3, -2]])[label] + rng.normal(size=(n, 2))
    return spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))], "id long, label int, x array<double>")


def test_softmax_head_separates_blobs_and_ignores_absent_classes(spark):
    df = blobs(spark)
    state = train.fit_softmax_head(df, "x", "label", 4)
    scored = argmax_class(score_dense(df, state.layers, "x"))
    assert scored.where("label = y_pred").count() > 0.95 * 1200
    assert scored.where("y_pred = 3").count() == 0


@pytest.mark.parametrize("rule,dropout", [("adam", 0.0), ("rmsprop", 0.2), ("sgd", 0.0)])
def test_dense_classifier_learns(spark, rule, dropout):
    lr = {"adam": 0.02, "rmsprop": 0.01, "sgd": 0.1}[rule]
    df = hash_split(blobs(spark), "id", 0.2)
    state, history = train.fit_dense(df, "id", "x", "label", [16], "sparse_ce", 5, outputs=3, optimizer=Optimizer(rule, lr), dropout=dropout, split="split")
    rows = history.orderBy("epoch").collect()
    assert rows[-1].loss < rows[0].loss and rows[-1].val_accuracy > 0.9
    scored = argmax_class(score_dense(df, state.layers, "x", state.output))
    assert scored.where("label = y_pred").count() > 0.9 * 1200


def test_dense_regression_ignores_input_partitioning(spark):
    points = synth_samples(spark, 1500, -3, 3, seed=5).withColumn("x", F.array("x1", "x2"))
    fits = [train.fit_dense(points.repartition(p), "id", "x", "y", [32], "mse", 3, optimizer=Optimizer("adam", 0.01)) for p in (1, 13)]
    assert np.array_equal(fits[0][0].weights, fits[1][0].weights)
    losses = [r.loss for r in fits[0][1].orderBy("epoch").collect()]
    assert losses[-1] < losses[0]


def test_dense_resume_equals_one_go_for_plain_sgd(spark):
    df = blobs(spark, 300)
    rule = Optimizer("sgd", 0.05)
    fit = dict(hidden=[8], loss="sparse_ce", outputs=3, optimizer=rule)
    whole, _ = train.fit_dense(df, "id", "x", "label", epochs=3, **fit)
    part, _ = train.fit_dense(df, "id", "x", "label", epochs=1, **fit)
    rest, _ = train.resume(train.fit_dense, part, df, "id", "x", "label", epochs=2, **fit)
    assert np.allclose(rest.weights, whole.weights)


def test_dense_without_hidden_layer_is_a_mini_batch_logistic_unit(spark, line):
    df = hash_split(line.withColumn("label", (F.col("y") > 3).cast("int")).withColumn("f", F.array("x")), "id", 0.25)
    _, history = train.fit_dense(df, "id", "f", "label", [], "binary_ce", 4, optimizer=Optimizer("adam", 0.1), split="split",
                                 schedule=lambda e, lr: 0.1 if e < 2 else 0.05)
    rows = history.orderBy("epoch").collect()
    assert rows[-1].val_accuracy > 0.9 and rows[-1].loss < rows[0].loss
    assert [r.lr for r in rows] == [0.1, 0.1, 0.05, 0.05]


def test_one_full_batch_step_is_the_plain_gradient_step(spark):
    df = blobs(spark, 90)
    rule = Optimizer("sgd", 0.1)
    state, _ = train.fit_dense(df, "id", "x", "label", [4], "sparse_ce", 1, outputs=3, optimizer=rule, batch=1000, buckets=1, seed=9)
    rows = df.collect()
    x, y = np.array([r.x for r in rows]), np.array([float(r.label) for r in rows])
    start = dense.glorot([2, 4, 3], 9)
    g, _, _ = dense.gradient(start, [2, 4, 3], x, y, "softmax", 0.0, None)
    assert np.allclose(state.weights, start - 0.1 * g)
    numeric = np.zeros_like(start)
    for i in range(len(start)):
        for sign in (1, -1):
            w = start.copy()
            w[i] += sign * 1e-6
            loss, _ = dense.row_losses(dense.predict(dense.unpack(w, [2, 4, 3]), x, "softmax"), y, "softmax")
            numeric[i] += sign * loss / len(y) / 2e-6
    assert np.allclose(g, numeric, atol=1e-5)


def test_averaging_on_the_cluster_equals_the_driver(spark, monkeypatch):
    df = blobs(spark, 400)
    fit = dict(hidden=[4], loss="sparse_ce", epochs=2, outputs=3, optimizer=Optimizer("adam", 0.02))
    here, _ = train.fit_dense(df, "id", "x", "label", **fit)
    monkeypatch.setattr(train, "DRIVER_DOUBLES", 0)
    there, _ = train.fit_dense(df, "id", "x", "label", **fit)
    assert np.allclose(here.weights, there.weights, rtol=0, atol=1e-12)


def test_scheduled_rate_is_recorded(spark, line):
    _, history = train.fit_linear_gd(line, "x", "y", 4, steps=1, schedule=lambda e, lr: 0.001 if e < 2 else 0.0001)
    assert [r.lr for r in history.orderBy("epoch").collect()] == [0.001, 0.001, 0.0001, 0.0001]
    assert math.isfinite(history.agg(F.max("loss")).first()[0])


def test_fits_release_what_they_keep(spark, line):
    df = line.withColumn("label", (F.col("y") > 3).cast("int"))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train.fit_logistic(df, "x", "label", 2)
    train.fit_dense(df.withColumn("f", F.array("x")), "id", "f", "y", [4], "mse", 2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_kept_spreads_an_overfull_partition_and_leaves_even_ones(spark):
    with kept(spark.range(4000).coalesce(1)) as data:
        counts = [r.n for r in data.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(counts) >= 4 and max(counts) <= 1100 and sum(counts) == 4000
    even = spark.range(0, 4000, 1, 4)
    with kept(even) as data:
        assert data is not None and data.count() == 4000
    held = even.persist()
    with kept(even.select((F.col("id") + 1).alias("next")), source=held) as data:
        assert not data.storageLevel.useMemory
    held.unpersist()


def test_linear_descent_leaves_out_incomplete_rows_and_takes_all_steps(spark):
    rows = [(float(i % 17) / 10, None if i % 5 == 0 else 3 + 2 * (i % 17) / 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, y double")
    fit = dict(optimizer=Optimizer("sgd", 0.05, 0.5))
    state, history = train.fit_linear_gd(df, "x", "y", 3, **fit)
    assert state.step == 3 * 75 and np.allclose(state.weights, [2, 3], atol=1e-3)
    old, train.STEPS_ONE_BY_ONE = train.STEPS_ONE_BY_ONE, 10**9
    try:
        slow, slow_history = train.fit_linear_gd(df, "x", "y", 3, **fit)
    finally:
        train.STEPS_ONE_BY_ONE = old
    assert np.allclose(state.weights, slow.weights) and np.allclose(state.slots, slow.slots)
    assert np.allclose([r.loss for r in history.orderBy("epoch").collect()], [r.loss for r in slow_history.orderBy("epoch").collect()])


def test_resume_continues_schedule_and_epochs(spark):
    df = blobs(spark, 200).withColumn("f", F.col("x")[0])
    halve = lambda epoch, lr: lr / 2
    fit = dict(optimizer=Optimizer("sgd", 0.1), schedule=halve)
    for kind, args in ((train.fit_logistic, (["f"], "label")), (train.fit_linear_gd, (["f"], "label"))):
        whole, all_rows = kind(df, *args, 3, **fit)
        part, _ = kind(df, *args, 1, **fit)
        rest, rows = train.resume(kind, part, df, *args, 2, **fit)
        assert np.allclose(rest.weights, whole.weights) and rest.epoch == 3
        assert [(r.epoch, r.lr) for r in rows.orderBy("epoch").collect()] == [(r.epoch, r.lr) for r in all_rows.orderBy("epoch").collect()][1:]


def test_dense_resume_with_dropout_equals_one_go(spark):
    df = blobs(spark, 300)
    fit = dict(hidden=[8], loss="sparse_ce", outputs=3, optimizer=Optimizer("sgd", 0.05), dropout=0.3, schedule=lambda e, lr: lr / 2)
    whole, _ = train.fit_dense(df, "id", "x", "label", epochs=3, **fit)
    part, _ = train.fit_dense(df, "id", "x", "label", epochs=1, **fit)
    rest, _ = train.resume(train.fit_dense, part, df, "id", "x", "label", epochs=2, **fit)
    assert np.allclose(rest.weights, whole.weights)
    with pytest.raises(ValueError):
        train.fit_dense(df.limit(0), "id", "x", "label", epochs=1, **fit)


def test_products_of_many_columns_equal_the_native_sums(spark, monkeypatch):
    df = spark.range(300).selectExpr("id % 7 * 1.0 AS a", "id % 11 / 3.0 AS b", "IF(id % 10 = 0, NULL, id % 5 + 1.0) AS y", "IF(id % 4 = 0, 'validation', 'train') AS split")
    native = train._moments(df, ["a", "b"], "y", "split", "validation")
    monkeypatch.setattr(train, "NATIVE_PRODUCTS", 1)
    wide = train._moments(df, ["a", "b"], "y", "split", "validation")
    assert native.keys() == wide.keys()
    for side in native:
        assert all(np.allclose(x, y) for x, y in zip(native[side], wide[side]))
