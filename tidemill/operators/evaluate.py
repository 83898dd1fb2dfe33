"""Losses, accuracy, confusion matrices and training curves."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidemill.functions import losses
from tidemill.functions.hashing import as_list
from tidemill.plans.lookup import pin_small, value_list
from tidemill.plans.ranking import ordered_row_number


def mse(df: DataFrame, y: str, y_hat: str) -> DataFrame:
    return df.agg(F.avg(losses.squared_error(F.col(y), F.col(y_hat))).alias("mse"))


def binary_cross_entropy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg(losses.binary_cross_entropy(F.col(y).cast("double"), F.col(p))).alias("loss"))


def categorical_cross_entropy(df: DataFrame, one_hot: str, probs: str) -> DataFrame:
    return df.agg(F.avg(losses.categorical_cross_entropy(F.col(one_hot), F.col(probs))).alias("loss"))


def sparse_cross_entropy(df: DataFrame, label: str, probs: str) -> DataFrame:
    return df.agg(F.avg(losses.sparse_cross_entropy(F.col(label), F.col(probs))).alias("loss"))


def accuracy(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return df.agg(F.avg(losses.correct(F.col(y_true), F.col(y_pred))).alias("accuracy"))


def evaluate(df: DataFrame, loss: Column, y_true: str = "y_true", y_pred: str = "y_pred", by: str = "split") -> DataFrame:
    """Loss, accuracy and row count per split, in one aggregate; ``loss`` is a per-row expression."""
    return df.groupBy(by).agg(
        F.avg(loss).alias("loss"),
        F.avg(losses.correct(F.col(y_true), F.col(y_pred))).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def confusion_counts(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """The observed cells (y_true, y_pred, n); map-side combined, so a dominant cell is one row per task."""
    return df.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def _class_pairs(counts: DataFrame, classes) -> DataFrame:
    """All (y_true, y_pred) of listed classes; a table of classes is numbered and paired by number, wherever its rows lie."""
    if isinstance(classes, DataFrame):
        values = classes.select(F.col(classes.columns[0]).alias("_c")).dropna().distinct()
        numbered = ordered_row_number(values, "_c", "_i")
        k = values.count()
        pairs = counts.sparkSession.range(k * k).select((F.floor(F.col("id") / k) + 1).alias("_a"), (F.col("id") % k + 1).alias("_b"))
        first, second = (numbered.select(F.col("_i").alias(i), F.col("_c").alias(c)) for i, c in (("_a", "y_true"), ("_b", "y_pred")))
        return pairs.join(first, "_a").join(second, "_b").select("y_true", "y_pred")
    literals = F.array(*[F.lit(c) for c in classes])
    cells = counts.sparkSession.range(1).select(F.explode(literals).alias("y_true"))
    return cells.select("y_true", F.explode(literals).alias("y_pred"))


def confusion_grid(counts: DataFrame, classes) -> DataFrame:
    """All K x K cells, zeros included, and the observed cells of classes not listed (or NULL): n sums to the counted rows."""
    cells = _class_pairs(counts, classes).join(counts, ["y_true", "y_pred"], "full")
    return cells.select("y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_pivot(counts: DataFrame, classes, prefix: str = "pred_") -> DataFrame:
    """One row per true class, one column per listed class, and one for all other predictions, missing ones included."""
    values = value_list(classes.select(classes.columns[0])) if isinstance(classes, DataFrame) else list(classes)
    total = lambda rows: F.coalesce(F.sum(F.when(rows, F.col("n"))), F.lit(0)).cast("long")
    columns = [total(F.col("y_pred") == F.lit(c)).alias(f"{prefix}{c}") for c in values]
    rest = total(~F.coalesce(F.col("y_pred").isin(values), F.lit(False))).alias(f"{prefix}other")
    return counts.groupBy("y_true").agg(*columns, rest)


def confusion_normalized(counts: DataFrame) -> DataFrame:
    """Each cell over its true class's total; NULL for a class without rows."""
    total = F.sum("n").over(Window.partitionBy("y_true"))  # K cells per class
    return counts.withColumn("share", F.try_divide(F.col("n").cast("double"), total.cast("double")))


def confusion_highlight(grid: DataFrame) -> DataFrame:
    """Flag cells above the midpoint between the grid's smallest and largest count."""
    midpoint = grid.agg((F.max("n") + F.min("n")) / F.lit(2.0)).scalar()
    return grid.withColumn("highlight", F.col("n") > midpoint)


def class_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per true class: correct, total, recall."""
    hits = df.groupBy(F.col(y_true).alias("y_true")).agg(
        F.sum(F.coalesce(F.col(y_true) == F.col(y_pred), F.lit(False)).cast("long")).alias("correct"), F.count(F.lit(1)).alias("total"))
    return hits.withColumn("recall", F.col("correct") / F.col("total"))


def alignment(truth: DataFrame, pred: DataFrame, key) -> DataFrame:
    """One row: rows on each side, matched keys, and keys with unequal row counts.

    A union and a map-side combined count replace a full outer join, so a key
    that repeats costs one row per task.
    """
    keys = as_list(key)
    tagged = truth.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_p")).unionByName(
        pred.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_p")))
    per_key = tagged.groupBy(*keys).agg(F.sum("_t").alias("_t"), F.sum("_p").alias("_p"))
    return per_key.agg(
        F.coalesce(F.sum("_t"), F.lit(0)).alias("n_truth"),
        F.coalesce(F.sum("_p"), F.lit(0)).alias("n_pred"),
        F.count_if(F.col("_t") == F.col("_p")).alias("matched_keys"),
        F.count_if(F.col("_p") < F.col("_t")).alias("short_pred_keys"),
        F.count_if(F.col("_t") < F.col("_p")).alias("short_truth_keys"),
    )


def check_aligned(truth: DataFrame, pred: DataFrame, key) -> None:
    """Raise unless truth and predictions cover the same keys equally often."""
    row = alignment(truth, pred, key).first()
    if row.short_pred_keys or row.short_truth_keys:
        raise ValueError(
            f"truth ({row.n_truth} rows) and predictions ({row.n_pred} rows) differ on {row.short_pred_keys + row.short_truth_keys} keys")


METRICS = ("loss", "val_loss", "accuracy", "val_accuracy")


#: Key buckets two tables are compared by; their digests are a table of so many rows at most.
BUCKETS = 1 << 16


def bucket_digests(df: DataFrame, key, buckets: int = BUCKETS) -> DataFrame:
    """Rows and an order-independent digest of all columns per bucket of keys, combined map-side."""
    # The hash passes over missing values, so where they are is hashed, too; nested values go by their spelling.
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType))}
    columns = sorted(df.columns)
    values = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if c in nested else F.col(c) for c in columns]
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    hashed = df.select(F.pmod(F.xxhash64(*as_list(key)), F.lit(buckets)).alias("bucket"), F.xxhash64(*values, gaps).alias("_h"))
    low = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(F.shiftrightunsigned("_h", 32)).alias("high"), F.bit_xor("_h").alias("mixed"))


def reconcile(truth: DataFrame, pred: DataFrame, key, buckets: int = BUCKETS) -> DataFrame:
    """Rows that two tables do not hold equally often: all columns, n_truth, n_pred.

    Digests of key buckets are compared first, and only the rows of buckets
    that differ are shuffled: none if the tables are equal.  A changed row
    comes twice, as it was and as it is.  Both sides need the same columns;
    rows may repeat, NULL equals NULL.
    """
    columns = truth.columns
    if sorted(columns) != sorted(pred.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(pred.columns))}")
    sums = ["n", "low", "high", "mixed"]
    sides = bucket_digests(truth, key, buckets).select("bucket", *sums, F.lit(1).alias("side")).unionAll(bucket_digests(pred, key, buckets).select("bucket", *sums, F.lit(2).alias("side")))
    # A bucket that is the same on both sides is one group of two rows.
    same = sides.groupBy("bucket", *sums).agg(F.count(F.lit(1)).alias("_k")).where("_k < 2")
    unequal = pin_small(same.select("bucket").distinct(), buckets)

    def suspects(df: DataFrame, side: int) -> DataFrame:
        marked = df.select(*columns, F.pmod(F.xxhash64(*as_list(key)), F.lit(buckets)).alias("bucket"), F.lit(side).alias("_side"))
        return marked.join(F.broadcast(unequal), "bucket", "left_semi").drop("bucket")

    both = suspects(truth, 1).unionByName(suspects(pred, 2))
    counts = both.groupBy(*columns).agg(F.count_if(F.col("_side") == 1).alias("n_truth"), F.count_if(F.col("_side") == 2).alias("n_pred"))
    return counts.where(F.col("n_truth") != F.col("n_pred"))


def curves(history: DataFrame) -> DataFrame:
    """Tidy (epoch, metric, phase, value, available) rows of a training history.

    A metric is available only if both phases have values; accuracy columns
    may be missing altogether, losses may not.
    """
    for required in ("loss", "val_loss"):
        if required not in history.columns:
            raise ValueError(f"a history needs {required}")
    full = history.select("epoch", *[F.col(m) if m in history.columns else F.lit(None).cast("double").alias(m) for m in METRICS])
    long = full.unpivot(["epoch"], list(METRICS), "_name", "value")
    known = full.agg(*[(F.count(m) > 0).alias(m) for m in METRICS])
    flags = known.select(F.struct((F.col("loss") & F.col("val_loss")).alias("loss"), (F.col("accuracy") & F.col("val_accuracy")).alias("accuracy"))).scalar()
    metric = F.when(F.col("_name").endswith("accuracy"), "accuracy").otherwise("loss")
    phase = F.when(F.col("_name").startswith("val_"), "validation").otherwise("train")
    tidy = long.select("epoch", metric.alias("metric"), phase.alias("phase"), "value").withColumn("_f", flags)
    available = F.when(F.col("metric") == "loss", F.col("_f.loss")).otherwise(F.col("_f.accuracy"))
    return tidy.withColumn("available", available).drop("_f")
