"""Curation, transforms, augmentation, scoring, evaluation and tracking on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.operators import augment, curate, evaluate, score, track, transform
from tidemill.sources import synthetic


def images(spark, n=6, h=4, w=5, c=3):
    rng = np.random.default_rng(1)
    data = rng.random((n, h * w * c)).astype("float32")
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id long, pixels array<float>"), data.reshape(n, h, w, c)


def pixels(df, col="pixels"):
    return np.array([r[col] for r in df.orderBy("id").collect()])


IDENTITY = {"angle": 0.0, "shift_y": 0.0, "shift_x": 0.0, "shear": 0.0, "zoom_y": 1.0, "zoom_x": 1.0, "flip_h": False, "flip_v": False}


def with_parameters(df, **changes):
    return df.withColumns({k: F.lit(v) for k, v in {**IDENTITY, **changes}.items()})


def test_class_subset_by_list_and_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, label string")
    by_list = {r.id for r in curate.class_subset(df, ["a", "c"]).collect()}
    by_table = {r.id for r in curate.class_subset(df, df.where("id != 2").select("label")).collect()}
    assert by_list == by_table == {1, 3}


def test_class_filter_reaches_the_scan(spark, sf_dir):
    plan = curate.class_subset(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["src0", "src3"], "source").select("doc_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(source" in text and "struct<doc_id:bigint,source:string>" in text


def test_class_index_beyond_the_lookup_limit(spark, monkeypatch):
    df = spark.range(5000).select(F.format_string("n%05d", (F.col("id") * 37) % 5000).alias("label"))
    monkeypatch.setattr("tidemill.plans.lookup.pin_small.__defaults__", (10,))
    rows = curate.class_index(df).collect()
    assert [r.label for r in sorted(rows, key=lambda r: r.class_index)] == sorted(r.label for r in rows)
    assert [r.class_index for r in sorted(rows, key=lambda r: r.class_index)] == list(range(5000))


def test_link_once_adds_nothing_twice(spark):
    manifest = spark.createDataFrame([("a",), ("a",)], "k string")
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    first = curate.link_once(df, manifest, "k")
    assert sorted((r.k, r.status) for r in first.collect()) == [("a", "exists"), ("b", "exists"), ("b", "linked")]
    manifest = manifest.unionByName(first.where("status = 'linked'").select("k"))
    assert {r.status for r in curate.link_once(df, manifest, "k").collect()} == {"exists"}


def test_scaler_uses_training_rows_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (100.0, 5.0)], "a double, b double")
    got = transform.apply_scaler(df, transform.fit_scaler(df.where("a < 50"), ["a", "b"]), ["a", "b"]).collect()
    assert [r.a_std for r in got] == [-1.0, 1.0, 98.0] and [r.b_std for r in got] == [0.0, 0.0, 0.0]


def test_array_scaler_agrees_with_numpy(spark):
    df, data = images(spark)
    flat = data.reshape(6, -1).astype(float)
    wide = df.withColumn("pixels", F.col("pixels").cast("array<double>"))
    got = pixels(transform.apply_array_scaler(wide, transform.fit_array_scaler(wide, "pixels"), "pixels"))
    assert np.allclose(got, (flat - flat.mean(0)) / flat.std(0))


def test_center_by_group_and_rescale(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "g string, x double")
    assert sorted(r.x_centered for r in transform.center(df, "x", by="g").collect()) == [-1.0, 0.0, 1.0]
    assert [r.x for r in transform.rescale(df, "x", 2.0).orderBy("x").collect()] == [0.5, 1.5, 5.0]


def test_argmax_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "probs array<double>")
    assert transform.argmax_class(df).first().y_pred == 1


def test_resize_and_channel_modes(spark):
    df, data = images(spark)
    got = pixels(transform.resize_images(df, 4, 5, 3, 6, 2)).reshape(6, 6, 2, 3)
    rows, cols = np.floor(np.arange(6) * 4 / 6).astype(int), np.floor(np.arange(2) * 5 / 2).astype(int)
    assert np.allclose(got, data[:, rows][:, :, cols])
    means = transform.channel_means(df, 3)
    shifted = pixels(transform.normalize_channels(df, "subtract_mean", 3, means)).reshape(data.shape)
    assert np.allclose(shifted, data - data.mean(axis=(0, 1, 2)), atol=1e-6)
    assert np.allclose(pixels(transform.normalize_channels(df, "unit_range")).reshape(data.shape), data / 127.5 - 1, atol=1e-6)


def test_flip_twice_is_the_identity(spark):
    df, _ = images(spark, c=1)
    rows = transform.reshape(df, 4, 5)
    for axis in ("horizontal", "vertical"):
        once = augment.flip(rows, axis)
        assert not np.array_equal(pixels(once), pixels(rows))
        assert np.array_equal(pixels(augment.flip(once, axis)), pixels(rows))
    assert np.array_equal(pixels(transform.flatten_rows(rows)), pixels(df))


def test_affine_identity_half_turn_and_shift(spark):
    df, data = images(spark)
    shape = data.shape
    assert np.array_equal(pixels(augment.affine(with_parameters(df), 4, 5, 3)).reshape(shape), data)
    half = pixels(augment.affine(with_parameters(df, angle=180.0), 4, 5, 3)).reshape(shape)
    assert np.array_equal(half, data[:, ::-1, ::-1])
    both = pixels(augment.affine(with_parameters(df, flip_h=True, flip_v=True), 4, 5, 3)).reshape(shape)
    assert np.array_equal(both, half)
    moved = pixels(augment.affine(with_parameters(df, shift_y=0.25), 4, 5, 3)).reshape(shape)
    assert np.array_equal(moved[:, :3], data[:, 1:]) and np.array_equal(moved[:, 3], data[:, 3])


def test_plan_changes_only_training_rows_and_repeats(spark):
    df = spark.range(40).withColumn("split", F.when(F.col("id") < 30, "train").otherwise("test"))
    plan = augment.augment_plan(df, "id", 4, split="split")
    rows = plan.collect()
    assert len(rows) == 30 * 4 + 10
    assert all(r.angle == 0 and r.zoom_x == 1 and not r.flip_h for r in rows if r.split == "test")
    assert all(abs(r.angle) <= 20 and abs(r.shift_x) <= 0.1 and 0.8 <= r.zoom_y <= 1.2 for r in rows)
    again = augment.augment_plan(df.repartition(7), "id", 4, split="split").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_map_images_handles_mixed_sizes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (3, [4.0, 5.0])], "id long, pixels array<float>")
    got = augment.map_images(df, lambda x: x.sum(axis=1, keepdims=True))
    assert {r.id: r.pixels for r in got.collect()} == {1: [3.0], 2: [3.0], 3: [9.0]}


def test_dense_scores_and_surface(spark):
    rng = np.random.default_rng(0)
    layers = [(rng.normal(size=(2, 4)), rng.normal(size=4)), (rng.normal(size=(4, 3)), rng.normal(size=3))]
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [-1.0, 0.5])], "id long, x array<double>")
    probs = pixels(score.score_dense(df, layers, "x"), "probs")
    assert np.allclose(probs, dense.predict(layers, np.array([[1.0, 2.0], [-1.0, 0.5]]), "softmax"))
    linear = [(np.array([[2.0], [1.0]]), np.array([0.5]))]
    rows = score.predict_surface(spark, linear, -5, 5, 11).collect()
    assert len(rows) == 121
    assert all(abs(r.y_hat - (2 * r.x1 + r.x2 + 0.5)) < 1e-12 and r.extrapolated == (max(abs(r.x1), abs(r.x2)) > 3) for r in rows)


def test_samples_stay_in_range(spark):
    rows = synthetic.synth_samples(spark, 200, -3, 3, seed=1).collect()
    assert len(rows) == 200 and all(-3 <= r.x1 < 3 and -3 <= r.x2 < 3 for r in rows)
    assert all(abs(r.y - (np.cos(2 * r.x1) + np.cos(3 * r.x2))) < 1e-12 for r in rows)
    grid = synthetic.grid(spark, -3, 3, 50).orderBy("id").collect()
    assert len(grid) == 2500 and grid[0].x1 == -3 and grid[49].x1 == 3 and grid[1].x2 == -3 and grid[-1].x2 == 3


def test_one_hot_and_sparse_losses_agree(spark):
    df = spark.createDataFrame([(0, [0.7, 0.3]), (1, [0.4, 0.6]), (1, [1.0, 0.0])], "label int, probs array<double>")
    sparse = evaluate.sparse_cross_entropy(df, "label", "probs").first().loss
    coded = evaluate.categorical_cross_entropy(curate.one_hot(df, "label", 2), "one_hot", "probs").first().loss
    assert abs(sparse - coded) < 1e-12 and abs(sparse - np.mean([-np.log(0.7), -np.log(0.6), -np.log(1e-7)])) < 1e-9


def test_confusion_frames(spark):
    df = spark.createDataFrame([("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2, "y_true string, y_pred string")
    counts = evaluate.confusion_counts(df)
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    grid = evaluate.confusion_grid(counts, names)
    cells = {(r.y_true, r.y_pred): r.n for r in grid.collect()}
    assert len(cells) == 9 and cells["a", "a"] == 3 and cells["c", "a"] == 0
    shares = {(r.y_true, r.y_pred): r.share for r in evaluate.confusion_normalized(grid).collect()}
    assert shares["a", "b"] == 0.25 and shares["c", "c"] is None
    lit = {(r.y_true, r.y_pred) for r in evaluate.confusion_highlight(grid).where("highlight").collect()}
    assert lit == {("a", "a"), ("b", "b")}
    wide = {r.y_true: (r.pred_a, r.pred_b, r.pred_c) for r in evaluate.confusion_pivot(grid, names).collect()}
    assert wide == {"a": (3, 1, 0), "b": (0, 2, 0), "c": (0, 0, 0)}
    assert {r.y_true: r.recall for r in evaluate.class_report(df).collect()} == {"a": 0.75, "b": 1.0}


def test_alignment_is_enforced(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    evaluate.check_aligned(a, a.repartition(3), "k")
    with pytest.raises(ValueError, match="differ on 1 keys"):
        evaluate.check_aligned(a, a.unionByName(a.where("k = 1")), "k")


def test_curves_mark_missing_accuracy(spark):
    history = spark.createDataFrame([(0, 1.0, 2.0), (1, 0.5, 1.5)], "epoch int, loss double, val_loss double")
    rows = evaluate.curves(history).collect()
    assert len(rows) == 8 and {(r.metric, r.available) for r in rows} == {("loss", True), ("accuracy", False)}
    with pytest.raises(ValueError):
        evaluate.curves(history.drop("val_loss"))


def test_run_store(spark, fresh):
    store = track.RunStore(spark, fresh("runs"))
    run = store.start_run("check")
    store.log_metrics("check", run, spark.createDataFrame([("foo", 1.0), ("bar", 2.0)], "key string, value double"))
    store.autolog("check", run, spark.createDataFrame([(0, 3.0, None), (1, 2.0, None)], "epoch int, loss double, accuracy double"))
    other = store.start_run("check")
    store.log_metrics("check", other, spark.createDataFrame([("loss", 2.5)], "key string, value double"))
    assert store.runs().count() == 2
    latest = {(r.run_id, r.key): r.value for r in track.latest_metrics(store.metrics()).collect()}
    assert latest == {(run, "foo"): 1.0, (run, "bar"): 2.0, (run, "loss"): 2.0, (other, "loss"): 2.5}
    assert {r.run_id: r["rank"] for r in track.compare_runs(store.metrics(), "loss").collect()} == {run: 1, other: 2}
    plan = store.metrics().where("experiment = 'check'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(experiment" in plan


def test_links_are_appended_once(spark, fresh):
    path = fresh("manifest")
    df = spark.createDataFrame([("a",), (None,), (None,), ("a",), ("b",)], "k string")
    for expected in (3, 0):
        try:
            manifest = spark.read.schema("k string").parquet(path)
        except Exception:
            manifest = df.limit(0)
        marked = curate.link_once(df, manifest, "k")
        assert marked.where("status = 'linked'").count() == expected
        curate.append_links(marked, path)
    assert spark.read.parquet(path).count() == 3


def test_ragged_vectors_raise_and_missing_ones_stay_missing(spark):
    from tidemill.operators.score import extract_features

    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])], "id int, v array<double>")
    got = {r.id: r.frozen for r in extract_features(df, "v", 2, 2, fn=lambda x: x * 2).collect()}
    assert got == {1: [2.0, 4.0], 2: None, 3: [6.0, 8.0]}
    ragged = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0, 2.0, 3.0, 4.0, 5.0],)], "v array<double>").coalesce(1)
    with pytest.raises(Exception, match="one length"):
        extract_features(ragged, "v", 4, 2, fn=lambda x: x).collect()


def test_resize_takes_sizes_by_row_and_keeps_missing_images(spark):
    df = spark.createDataFrame([(1, 2, 2, [1.0, 2.0, 3.0, 4.0]), (2, 1, 3, [5.0, 6.0, 7.0]), (3, 2, 2, None), (4, None, 2, [1.0, 2.0])], "k int, h int, w int, pixels array<double>")
    got = {r.k: r.pixels for r in transform.resize_images(df, F.col("h"), F.col("w"), 1, 2, 3).collect()}
    assert got == {1: [1.0, 1.0, 2.0, 3.0, 3.0, 4.0], 2: [5.0, 6.0, 7.0] * 2, 3: None, 4: None}
    with pytest.raises(Exception, match="is not"):
        transform.resize_images(df.where("k = 1"), 3, 3, 1, 2, 2).collect()


def test_grid_of_a_table_of_classes(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", None), (None, "a"), ("z", "a")], "y_true string, y_pred string")
    counts = evaluate.confusion_counts(rows)
    table = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "name string")
    by_table, by_list = (sorted(map(str, evaluate.confusion_grid(counts, c).collect())) for c in (table, ["a", "b", "c"]))
    assert by_table == by_list and len(by_table) == 12


def test_warps_keep_missing_images_and_refuse_ragged_ones(spark):
    df = spark.createDataFrame([(1, [1.0] * 4), (2, None), (3, [2.0] * 4)], "k int, pixels array<float>")
    plan = augment.augment_plan(df, "k", 2)
    got = augment.affine(plan, 2, 2, 1).select("k", "pixels").collect()
    assert sorted((r.k, r.pixels and r.pixels[0]) for r in got) == [(1, 1.0)] * 2 + [(2, None)] * 2 + [(3, 2.0)] * 2
    ragged = spark.createDataFrame([(1, [1.0] * 3), (2, [1.0] * 5)], "k int, pixels array<float>")
    with pytest.raises(Exception, match="is not"):
        augment.affine(augment.augment_plan(ragged, "k", 1), 2, 2, 1).collect()
