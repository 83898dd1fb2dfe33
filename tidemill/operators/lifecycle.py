"""The usual end-to-end jobs, composed from the other operators."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.losses import binary_cross_entropy, sparse_cross_entropy
from tidemill.operators import augment, curate, evaluate, score, split, train, transform
from tidemill.plans.iterate import kept
from tidemill.plans.scratch import scratch_dir
from tidemill.sources.files import read_images, read_labeled_files


@dataclass
class Outcome:
    """What a job leaves behind: the fitted state and small result tables."""

    state: train.FitState
    history: DataFrame | None
    scores: DataFrame
    confusion: DataFrame
    undecoded: int = 0


def classify_table(df: DataFrame, key, features: list[str], label: str, epochs: int = 300, optimizer="adam", fraction: float = 0.33, seed=42) -> Outcome:
    """Binary classification of numeric columns: exact split, scaling fitted on the
    training side, a logistic unit, loss and accuracy of both sides."""
    sides = split.exact_split(df, key, fraction, seed)
    stats = transform.fit_scaler(sides.where(F.col("split") == "train"), features)
    scaled = transform.apply_scaler(sides, stats, features, "_z").withColumn("y_true", F.col(label).cast("int"))
    zscores = [f"{c}_z" for c in features]
    with kept(scaled.select("split", "y_true", *zscores)) as data:
        state, history = train.fit_logistic(data, zscores, "y_true", epochs, optimizer, split="split", validation="test")
        z = F.lit(float(state.weights[-1]))
        for w, c in zip(state.weights, zscores):
            z = z + F.lit(float(w)) * F.col(c)
        scored = data.withColumn("p", 1.0 / (1.0 + F.exp(-z))).withColumn("y_pred", (F.col("p") > 0.5).cast("int"))
        loss = binary_cross_entropy(F.col("y_true").cast("double"), F.col("p"))
        # Two and four rows, taken while the input is kept.
        scores = _local(evaluate.evaluate(scored, loss))
        counts = _local(evaluate.confusion_counts(scored.where(F.col("split") == "test")))
    return Outcome(state, history, scores, evaluate.confusion_grid(counts, [0, 1]))


def classify_arrays(
    df: DataFrame, key, pixels: str, label: str, classes: int, hidden: list[int], epochs: int, divisor: float = 255.0, dropout: float = 0.2,
    optimizer="adam", fraction: float = 0.2, seed: int = 42,
) -> Outcome:
    """Array classification: rescaling, a held-out share, a fully connected network."""
    scaled = transform.rescale(df.withColumn("_x", F.col(pixels).cast("array<double>")), "_x", divisor)
    sides = split.hash_split(scaled, key, fraction, seed)
    state, history = train.fit_dense(sides, key, "_x", label, hidden, "sparse_ce", epochs, outputs=classes, optimizer=optimizer, dropout=dropout, seed=seed, split="split")
    return _judge_softmax(sides.select("split", F.col(label).cast("int").alias("y_true"), "_x"), "_x", state, history, list(range(classes)), "validation")


def classify_folders(
    spark: SparkSession, root: str, height: int, width: int, train_folder: str = "Training", test_folder: str = "Test", glob: str = "*",
    fraction: float = 0.2, variants: int = 1, features: int = 64, backbone: Callable | None = None, max_iter: int = 30, seed: int = 42,
    preprocess: str = "unit_range",
) -> Outcome:
    """Transfer learning on a class-per-folder tree.

    Validation files are chosen from the listing, images decoded once, training
    images augmented, frozen features written as a table, and a softmax head
    fitted on it.  ``backbone`` maps (n, pixels) to (n, features).  Files that
    cannot be decoded take no part after the cuts; the outcome counts them.
    ``preprocess`` is a mode of ``normalize_channels``; channel means are those
    of the training images.
    """
    listing = read_labeled_files(spark, root, glob).where(F.col("split") == train_folder).select("path", "label")
    dictionary = curate.class_index(listing)
    classes = dictionary.count()
    cuts = split.class_cuts(listing, "path", fraction)
    images = read_images(spark, root, glob, rgb=True)
    sided = split.apply_class_cuts(images, cuts, "path", out="_side")
    side = F.when(F.col("split") == train_folder, F.col("_side")).when(F.col("split") == test_folder, "test")
    sized = transform.resize_images(sided.withColumn("split", side).where(F.col("split").isNotNull() & F.col("decoded")), F.col("height"), F.col("width"), 3, height, width)
    warped = augment.affine(augment.augment_plan(sized, "path", variants, seed=seed, split="split"), height, width, 3)
    means = transform.channel_means(sized.where(F.col("split") == "train"), 3) if preprocess == "subtract_mean" else None
    ready = transform.normalize_channels(warped.select("path", "variant", "split", "label", "pixels"), preprocess, means=means)
    frozen = score.extract_features(ready, "pixels", height * width * 3, features, seed, backbone).drop("pixels")
    path = scratch_dir(spark, "features")
    curate.attach_names(frozen, dictionary, "label").write.parquet(path)
    table = spark.read.parquet(path)
    state = train.fit_softmax_head(table.where(F.col("split") == "train"), "frozen", "class_index", classes, max_iter)
    outcome = _judge_softmax(table.select("split", F.col("class_index").alias("y_true"), F.col("frozen").alias("_x")), "_x", state, train.softmax_history(spark, state), list(range(classes)), "test")
    listed = read_labeled_files(spark, root, glob).where(F.col("split").isin(train_folder, test_folder)).select("path").count()
    outcome.undecoded = listed - table.where(F.col("variant") == 0).count()
    named = outcome.confusion
    for side in ("y_true", "y_pred"):
        named = curate.attach_names(named, dictionary.select(F.col("class_index").alias(side), F.col("label").alias(f"{side}_name")), side)
    outcome.confusion = named
    return outcome


def _judge_softmax(df: DataFrame, x: str, state: train.FitState, history, classes: list, confusion_of: str) -> Outcome:
    scored = transform.argmax_class(score.score_dense(df, state.layers, x)).drop(x)
    scores = evaluate.evaluate(scored, sparse_cross_entropy(F.col("y_true"), F.col("probs")))
    counts = evaluate.confusion_counts(scored.where(F.col("split") == confusion_of))
    return Outcome(state, history, scores, evaluate.confusion_grid(counts, classes))


def _local(small: DataFrame) -> DataFrame:
    return small.sparkSession.createDataFrame(small.toArrow(), small.schema)
