"""Keyed permutations and synchronous mini-batches against a plain replay on one machine."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.functions.optimizers import Optimizer
from tidemill.operators import augment, split, track, train
from tidemill.operators.sync import Augmentation, fit_synchronous
from tidemill.plans.permute import Permutation


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 101, 1000, 65537])
def test_permutation_holds_every_position_once(n):
    orders = [Permutation(n, f"42:{e}").positions(np.arange(n)) for e in range(3)]
    for order in orders:
        assert sorted(order.tolist()) == list(range(n))
    if n > 50:
        assert len({tuple(o.tolist()) for o in orders}) == 3


def test_permutation_spreads_neighbours():
    n = 200_000
    order = Permutation(n, "1:0").positions(np.arange(n))
    assert abs(np.corrcoef(order, np.arange(n))[0, 1]) < 0.01 and abs(np.corrcoef(order[:-1], order[1:])[0, 1]) < 0.01
    cells = np.bincount(np.arange(n) // 2000 * 100 + order // 2000, minlength=10000)
    assert 0.9 < ((cells - 20.0) ** 2 / 20).sum() / 9999 < 1.1


@pytest.mark.parametrize("n", [1, 5, 1009])
def test_columns_and_arrays_agree_and_the_plan_moves_nothing(spark, n):
    order = Permutation(n, "9:4")
    placed = order.apply(spark.range(n).withColumn("r", F.col("id")), "r", "p")
    rows = np.array([[r.id, r.p] for r in placed.collect()])
    assert np.array_equal(order.positions(rows[:, 0]), rows[:, 1])
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    assert order.apply(spark.createDataFrame([(None,)], "r long"), "r", "p").first().p is None


def test_epoch_batches_hold_every_row_of_whole_batches_once(spark):
    ranked = split.global_row_number(spark.range(103), "id").cache()
    for epoch in range(2):
        rows = split.epoch_batches(ranked, 103, 10, 7, epoch).collect()
        assert sorted((r.batch_id, r.pos) for r in rows) == [(b, p) for b in range(10) for p in range(10)]
    assert len(split.epoch_batches(ranked, 103, 10, 7, 0, drop_remainder=False).collect()) == 103
    plan = split.epoch_order(ranked, 103, 7, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def points(spark, n=230):
    df = spark.range(n).select("id", F.sin("id").alias("a"), F.cos(F.col("id") * 1.7).alias("b"), F.when(F.col("id") % 5 == 0, "validation").otherwise("train").alias("split"))
    return df.withColumn("x", F.array("a", "b")).withColumn("y", F.col("a") * F.col("b")).withColumn("c", (F.col("id") % 3).cast("int")).withColumn("d", (F.col("y") > 0).cast("int"))


def replay(df, target, widths, output, rule, epochs, batch, seed=42, dropout=0.0, initial=None, drop_remainder=False):
    """The same on one machine: rows in rank order, batches by the permutation, one after another."""
    ranked = sorted(((r.rank, r.x, r[target]) for r in split.global_row_number(df.where("split = 'train'"), "id", seed).collect()))
    x, y, n = np.array([r[1] for r in ranked]), np.array([float(r[2]) for r in ranked]), len(ranked)
    held = [(r.x, r[target]) for r in df.where("split = 'validation'").collect()]
    vx, vy = np.array([h[0] for h in held]), np.array([float(h[1]) for h in held])
    w = dense.glorot(widths, seed)
    slots, step, history = rule.slots(len(w)), 0, []
    for epoch in range(epochs):
        order = np.argsort(Permutation(n, f"{seed}:{epoch}").positions(np.arange(n)))
        loss = seen = 0
        for at in range(0, n // batch * batch if drop_remainder else n, batch):
            rows = order[at:at + batch]
            g, part, _ = dense.gradient(w, widths, x[rows], y[rows], output, dropout, dense.RowDraws(seed, epoch, rows))
            step += 1
            w, slots = rule.update(w, g, slots, step, rule.lr)
            loss, seen = loss + part, seen + len(rows)
        history.append((loss / seen, dense.row_losses(dense.predict(dense.unpack(w, widths), vx, output), vy, output)[0] / len(vy)))
    return w, history


def same(a, b):
    return np.allclose(*(np.array([tuple(r) for r in x.orderBy("epoch").collect()], dtype=float) for x in (a, b)))


CASES = [
    ("y", [2, 3, 1], "mse", Optimizer("adam", 0.01), 16, 0.0, False),
    ("c", [2, 8, 5, 3], "sparse_ce", Optimizer("sgd", 0.05, 0.9), 32, 0.3, False),
    ("d", [2, 1], "binary_ce", Optimizer("rmsprop", 0.01), 50, 0.0, True),
]


@pytest.mark.parametrize("target,widths,loss,rule,batch,dropout,drop", CASES)
def test_any_number_of_workers_equals_the_replay(spark, target, widths, loss, rule, batch, dropout, drop):
    df = points(spark)
    want, steps = replay(df, target, widths, train.LOSS_OUTPUT[loss], rule, 3, batch, dropout=dropout, drop_remainder=drop)
    for workers in (1, 3, 4):
        state, history = fit_synchronous(
            df.repartition(5), "id", "x" if workers == 3 else ["a", "b"], target, widths[1:-1], loss, 3, outputs=widths[-1], optimizer=rule,
            batch=batch, dropout=dropout, workers=workers, split="split", drop_remainder=drop)
        assert np.allclose(state.weights, want, atol=1e-9)
        rows = history.orderBy("epoch").collect()
        assert np.allclose([(r.loss, r.val_loss) for r in rows], steps, atol=1e-9)
        assert (rows[0].val_accuracy is None) == (loss == "mse")


def test_gathers_of_the_barrier_give_the_same(spark):
    a, b = (fit_synchronous(points(spark, 20), "id", "x", "y", [2], "mse", 1, batch=16, workers=2, exchange=e)[0] for e in ("folder", "barrier"))
    assert np.array_equal(a.weights, b.weights)


def test_saved_in_the_middle_and_resumed_is_the_same_fit(spark, fresh):
    df, options = points(spark), dict(outputs=3, batch=20, dropout=0.2, workers=2, split="split")
    whole, history = fit_synchronous(df, "id", "x", "c", [6], "sparse_ce", 3, **options)
    half, first = fit_synchronous(df, "id", "x", "c", [6], "sparse_ce", 1, **options)
    train.save_state(spark, half, path := fresh("state"))
    rest, second = train.resume(fit_synchronous, train.load_state(spark, path), df, "id", "x", "c", [6], "sparse_ce", 2, **options)
    assert np.allclose(rest.weights, whole.weights) and rest.step == whole.step
    assert same(first.union(second), history)


def test_incomplete_rows_take_no_part_and_few_rows_leave_workers_idle(spark):
    df = points(spark, 6).select("id", "x", "y")
    gaps = df.union(spark.sql("SELECT 900L, array(1D, CAST(NULL AS DOUBLE)), 1D UNION ALL SELECT 901L, NULL, 1D UNION ALL SELECT 902L, array(1D, 2D), NULL"))
    a, _ = fit_synchronous(df, "id", "x", "y", [2], "mse", 2, batch=2, workers=4)
    b, _ = fit_synchronous(gaps, "id", "x", "y", [2], "mse", 2, batch=2, workers=1)
    assert np.allclose(a.weights, b.weights)
    with pytest.raises(ValueError, match="no training row"):
        fit_synchronous(df.limit(0), "id", "x", "y", [2], "mse", 1)
    with pytest.raises(ValueError, match="task slots"):
        fit_synchronous(df, "id", "x", "y", [2], "mse", 1, workers=10_000)


def test_augmented_epochs_equal_the_variants_written_out(spark, fresh):
    df = spark.range(60).select("id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.sin(F.col("id") * 3 + i).cast("float")).alias("pixels"), (F.col("id") % 2).cast("int").alias("c"), F.when(F.col("id") % 6 == 0, "validation").otherwise("train").alias("split"))
    options = dict(outputs=2, batch=8, workers=3, split="split", optimizer="sgd")
    state, history = fit_synchronous(df, "id", "pixels", "c", [4], "sparse_ce", 2, augment=Augmentation(4, 4), **options)
    step, parts = None, []
    for epoch in range(2):
        written = augment.affine(augment.augment_plan(df, "id", 1, seed=f"42:{epoch}", split="split"), 4, 4, 1).select("id", "pixels", "c", "split")
        step, one = fit_synchronous(written, "id", "pixels", "c", [4], "sparse_ce", 1, initial=step, **options)
        parts.append(one)
    assert np.allclose(step.weights, state.weights)
    assert same(parts[0].union(parts[1]), history)
    plain, _ = fit_synchronous(df, "id", "pixels", "c", [4], "sparse_ce", 2, **options)
    assert not np.allclose(plain.weights, state.weights)


def test_fits_in_an_active_run_log_each_epoch_and_keep_them_if_they_die(spark, fresh):
    store = track.RunStore(spark, fresh("runs"))

    def stop(epoch, rate):
        if epoch == 2:
            raise RuntimeError("lost")
        return rate

    df = points(spark)
    fits = {
        "sync": lambda: fit_synchronous(df, "id", "x", "y", [2], "mse", 5, workers=2, split="split", schedule=stop),
        "dense": lambda: train.fit_dense(df, "id", "x", "y", [2], "mse", 5, buckets=2, schedule=stop),
        "logistic": lambda: train.fit_logistic(df, ["a", "b"], "d", 5, split="split", schedule=stop),
        "linear": lambda: train.fit_linear_gd(df, ["a"], "b", 5, schedule=stop),
    }
    for name, fit in fits.items():
        with pytest.raises(RuntimeError, match="lost"), track.active_run(store, "trial", name):
            fit()
    with track.active_run(store, "trial", "whole"):
        train.fit_softmax_head(df, "x", "c", 3, max_iter=4)
    train.fit_linear_gd(df, ["a"], "b", 2)  # outside any run: logged nowhere
    found = {(r.run_id, r.key): r.steps for r in store.metrics().groupBy("run_id", "key").agg(F.sort_array(F.collect_list("step")).alias("steps")).collect()}
    assert all(found[name, "loss"] == [0, 1] for name in fits)
    assert found["sync", "val_loss"] == found["logistic", "val_loss"] == [0, 1]
    assert found["whole", "loss"] == list(range(len(found["whole", "loss"]))) and len(found["whole", "loss"]) > 1
    assert {r.run_id for r in store.runs().collect()} == {*fits, "whole"}


def test_saved_states_keep_losses_and_how_the_fit_ended(spark, fresh):
    state = train.FitState(np.ones(2), np.zeros((0, 2)), 3, [1, 1], "softmax", 3, None, [0.7, 0.5], True)
    train.save_state(spark, state, path := fresh("state"))
    back = train.load_state(spark, path)
    assert (back.losses, back.converged) == ([0.7, 0.5], True)
