from pyspark.sql import functions as F

from tidemill.functions import losses
from tidemill.operators import evaluate as e
from tidemill.operators.curate import one_hot
from tidemill.operators.split import hash_split
from tidemill.operators.score import score_dense
from tidemill.operators.transform import argmax_class
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import query, rounded, sql_round, sql_split, table
from tidemill.queries.score import fixed_head
from tidemill.streaming.cutoff import latest, run_batches, stream_accuracy
from tidemill.streaming.confusion import run_to_end, stream_confusion, stream_table

# The last class never occurs: a grid must still show it.
FLAGS = ["A", "N", "R", "X"]
PRED_SQL = "CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END"
COUNTS_SQL = f"SELECT l_returnflag AS y_true, {PRED_SQL} AS y_pred, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2"
GRID_SQL = f"""
    c AS ({COUNTS_SQL}), k AS (SELECT unnest({FLAGS!r}) AS y),
    g AS (SELECT a.y AS y_true, b.y AS y_pred, coalesce(n, 0)::BIGINT AS n FROM k a CROSS JOIN k b LEFT JOIN c ON c.y_true = a.y AND c.y_pred = b.y)"""


def predictions(spark, sf_dir):
    """True return flag against a rule on the quantity."""
    rule = F.when(F.col("l_quantity") < 17, "A").when(F.col("l_quantity") < 34, "N").otherwise("R")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("y_true"), rule.alias("y_pred"))


def _one_value(df, name):
    return df.select(rounded(F.col(name)).alias(name))


@query("mse", f"SELECT {sql_round('avg(pow(l_extendedprice / 1000 - l_quantity * 1.5::DOUBLE, 2))', 4)} AS mse FROM lineitem")
def mse(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.5).alias("y_hat"))
    return e.mse(items, "y", "y_hat").select(rounded(F.col("mse"), 4).alias("mse"))


P_SQL = "least(greatest(l_quantity / 50, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)"
BCE_SQL = f"-(y * ln({P_SQL}) + (1 - y) * ln(1 - {P_SQL}))"
BINARY_SQL = f"SELECT {sql_split('l_orderkey', 0.2)} AS split, (l_returnflag = 'R')::INT AS y, l_quantity FROM lineitem"


def binary(spark, sf_dir):
    items = hash_split(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity"), "l_orderkey", 0.2)
    return items.select("split", (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") / 50).alias("p"))


@query("binary_ce", f"SELECT {sql_round(f'avg({BCE_SQL})')} AS loss FROM ({BINARY_SQL})")
def binary_ce(spark, sf_dir):
    return _one_value(e.binary_cross_entropy(binary(spark, sf_dir), "y", "p"), "loss")


@query("evaluate_splits", f"""
    SELECT split, {sql_round(f'avg({BCE_SQL})')} AS loss, {sql_round('avg((y = (l_quantity / 50 > 0.5)::INT)::INT)')} AS accuracy, count(*)::BIGINT AS n
    FROM ({BINARY_SQL}) GROUP BY split""")
def evaluate_splits(spark, sf_dir):
    data = binary(spark, sf_dir).withColumn("y_pred", (F.col("p") > 0.5).cast("int"))
    loss = losses.binary_cross_entropy(F.col("y").cast("double"), F.col("p"))
    scores = e.evaluate(data, loss, "y", "y_pred")
    return scores.select("split", rounded(F.col("loss")).alias("loss"), rounded(F.col("accuracy")).alias("accuracy"), "n")


def softmax_of_all(spark, sf_dir):
    """Probabilities of 10 classes from all vector values, by the fixed layer."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("int").alias("label"), "embedding")
    return score_dense(vectors, fixed_head(), "embedding").select("label", "probs")


SPARSE_SQL = f"""
    WITH v AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    z AS (SELECT vec_id, label, j, exp(sum(v * (((7 * i + 13 * j) % 11 - 5) / 10.0::DOUBLE)) + (j - 4.5::DOUBLE) / 10) AS s FROM v, range(10) r(j) GROUP BY vec_id, label, j),
    p AS (SELECT label, j, s / sum(s) OVER (PARTITION BY vec_id) AS p FROM z)
    SELECT {sql_round('avg(-ln(least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)))')} AS loss FROM p WHERE j = label"""


@query("categorical_ce", SPARSE_SQL)
def categorical_ce(spark, sf_dir):
    return _one_value(e.categorical_cross_entropy(one_hot(softmax_of_all(spark, sf_dir), "label", 10), "one_hot", "probs"), "loss")


@query("sparse_ce", SPARSE_SQL)
def sparse_ce(spark, sf_dir):
    return _one_value(e.sparse_cross_entropy(softmax_of_all(spark, sf_dir), "label", "probs"), "loss")


@query("accuracy", f"SELECT {sql_round(f'avg((l_returnflag = {PRED_SQL})::INT)')} AS accuracy FROM lineitem")
def accuracy(spark, sf_dir):
    return _one_value(e.accuracy(predictions(spark, sf_dir)), "accuracy")


@query("confusion_counts", COUNTS_SQL)
def confusion_counts(spark, sf_dir):
    return e.confusion_counts(predictions(spark, sf_dir))


def _grid(spark, sf_dir):
    return e.confusion_grid(e.confusion_counts(predictions(spark, sf_dir)), FLAGS)


@query("confusion_grid", f"WITH {GRID_SQL} SELECT * FROM g")
def confusion_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


@query("confusion_pivot", f"""
    WITH c AS ({COUNTS_SQL}) SELECT y_true, {', '.join(f"coalesce(sum(n) FILTER (y_pred = '{c}'), 0)::BIGINT AS pred_{c}" for c in FLAGS)}, 0::BIGINT AS pred_other FROM c GROUP BY y_true""")
def confusion_pivot(spark, sf_dir):
    return e.confusion_pivot(e.confusion_counts(predictions(spark, sf_dir)), FLAGS)


@query("confusion_normalized", f"""
    WITH {GRID_SQL} SELECT y_true, y_pred, n, {sql_round('n / nullif(sum(n) OVER (PARTITION BY y_true), 0)::DOUBLE')} AS share FROM g""")
def confusion_normalized(spark, sf_dir):
    return e.confusion_normalized(_grid(spark, sf_dir)).withColumn("share", rounded(F.col("share")))


@query("confusion_highlight", f"WITH {GRID_SQL} SELECT y_true, y_pred, n, n > (SELECT (max(n) + min(n)) / 2.0 FROM g) AS highlight FROM g")
def confusion_highlight(spark, sf_dir):
    return e.confusion_highlight(_grid(spark, sf_dir))


@query("class_recall", f"""
    SELECT l_returnflag AS y_true, count(*) FILTER (l_returnflag = {PRED_SQL})::BIGINT AS correct, count(*)::BIGINT AS total,
           {sql_round(f'avg((l_returnflag = {PRED_SQL})::INT)')} AS recall FROM lineitem GROUP BY 1""")
def class_recall(spark, sf_dir):
    return e.class_report(predictions(spark, sf_dir)).withColumn("recall", rounded(F.col("recall")))


EVENT_RULE = "CASE WHEN value < 20 THEN 'click' WHEN value < 60 THEN 'view' ELSE 'purchase' END"


@query("stream_confusion", f"SELECT event_type AS y_true, {EVENT_RULE} AS y_pred, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def streamed_confusion(spark, sf_dir):
    """Event types against a rule on the value, counted while the table streams in."""
    schema = table(spark, sf_dir, "events").schema
    rule = F.when(F.col("value") < 20, "click").when(F.col("value") < 60, "view").otherwise("purchase")
    stream = stream_table(spark, f"{sf_dir}/events.parquet", schema).select(F.col("event_type").alias("y_true"), rule.alias("y_pred"))
    return run_to_end(stream_confusion(stream))


@query("stream_predictions", """
    WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    z AS (SELECT vec_id, label, j, sum(v * (((7 * i + 13 * j) % 11 - 5) / 10.0::DOUBLE)) + (j - 4.5::DOUBLE) / 10 AS s FROM e, range(10) r(j) GROUP BY vec_id, label, j),
    p AS (SELECT vec_id, label::INT AS y_true, arg_max(j, s)::INT AS y_pred FROM z GROUP BY vec_id, label)
    SELECT y_true, y_pred, count(*)::BIGINT AS n FROM p GROUP BY 1, 2""")
def stream_predictions(spark, sf_dir):
    """Vectors scored by a fixed layer as they stream in, confusion cells kept running."""
    schema = table(spark, sf_dir, "embeddings").schema
    stream = stream_table(spark, f"{sf_dir}/embeddings.parquet", schema).select(F.col("label").cast("int").alias("y_true"), "embedding")
    scored = argmax_class(score_dense(stream, fixed_head(), "embedding"))
    return run_to_end(stream_confusion(scored))


@query("alignment", """
    SELECT count(d.doc_id)::BIGINT AS n_truth, count(l.doc_id)::BIGINT AS n_pred, count(*) FILTER (d.doc_id = l.doc_id)::BIGINT AS matched_keys,
           count(*) FILTER (l.doc_id IS NULL)::BIGINT AS short_pred_keys, count(*) FILTER (d.doc_id IS NULL)::BIGINT AS short_truth_keys
    FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id""")
def alignment(spark, sf_dir):
    return e.alignment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


GAPS_SQL = "SELECT l_returnflag AS y_true, CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 11 = 0 THEN 'Z' ELSE l_linestatus END AS y_pred FROM lineitem"


def with_gaps(spark, sf_dir):
    """Predictions some of which are missing or of a class that is not listed."""
    gap = F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).when(F.col("l_partkey") % 11 == 0, "Z").otherwise(F.col("l_linestatus"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("y_true"), gap.alias("y_pred"))


@query("accuracy_with_gaps", f"SELECT {sql_round('avg(coalesce(y_true = y_pred, false)::INT)')} AS accuracy FROM ({GAPS_SQL})")
def accuracy_with_gaps(spark, sf_dir):
    return _one_value(e.accuracy(with_gaps(spark, sf_dir)), "accuracy")


@query("grid_unlisted", f"""
    WITH c AS (SELECT y_true, y_pred, count(*)::BIGINT AS n FROM ({GAPS_SQL}) GROUP BY 1, 2), k AS (SELECT unnest(['A', 'N', 'O']) AS y)
    SELECT a.y AS y_true, b.y AS y_pred, coalesce(n, 0)::BIGINT AS n FROM k a CROSS JOIN k b LEFT JOIN c ON c.y_true = a.y AND c.y_pred = b.y
    UNION ALL SELECT * FROM c WHERE NOT coalesce(y_true IN ('A', 'N', 'O') AND y_pred IN ('A', 'N', 'O'), false)""")
def grid_unlisted(spark, sf_dir):
    return e.confusion_grid(e.confusion_counts(with_gaps(spark, sf_dir)), ["A", "N", "O"])


@query("binary_ce_with_gaps", f"""
    SELECT isnan(loss) AS diverged, coalesce({sql_round('CASE WHEN isnan(loss) THEN NULL ELSE loss END')}, -1) AS loss FROM (
        SELECT avg({BCE_SQL}) AS loss FROM ({BINARY_SQL}) WHERE split = 'train'
        UNION ALL SELECT 'nan'::DOUBLE)""")
def binary_ce_with_gaps(spark, sf_dir):
    """A NULL probability is left out, a NaN shows in the loss."""
    data = binary(spark, sf_dir)
    nulls = data.withColumn("p", F.when(F.col("split") == "train", F.col("p").cast("double")))
    nans = data.withColumn("p", F.when(F.col("split") == "train", F.col("p").cast("double")).otherwise(F.lit(float("nan"))))
    loss = e.binary_cross_entropy(nulls, "y", "p").unionByName(e.binary_cross_entropy(nans, "y", "p"))
    return loss.select(F.isnan("loss").alias("diverged"), F.when(F.isnan("loss"), -1.0).otherwise(rounded(F.col("loss"))).alias("loss"))


@query("stream_cutoff", """
    WITH r AS (SELECT event_type AS run, event_id, event_type = CASE WHEN value < 20 THEN 'click' WHEN value < 60 THEN 'view' ELSE 'purchase' END AS correct,
                      row_number() OVER (PARTITION BY event_type ORDER BY length(event_id::VARCHAR), event_id::VARCHAR) AS place FROM events)
    SELECT run, count(*)::BIGINT AS n, count(*) FILTER (correct)::BIGINT AS correct, count(*) = 200 AS stopped FROM r WHERE place <= 200 GROUP BY 1""")
def stream_cutoff(spark, sf_dir):
    """The first 200 events of each type judged by the rule on the value, in micro-batches by key, one of them coming twice, with a restart before each."""
    events = table(spark, sf_dir, "events")
    folder, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "cutoff")
    # What is new since the last start is one micro-batch.
    edges = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    third = (edges.hi - edges.lo) // 3 + 1
    parts = [events.where(F.expr(f"(event_id - {edges.lo}) DIV {third} = {i}")) for i in (0, 1, 1, 2)]
    rule = F.when(F.col("value") < 20, "click").when(F.col("value") < 60, "view").otherwise("purchase")

    for part in parts:
        part.write.mode("append").parquet(folder)
        stream = stream_table(spark, folder, events.schema).withColumn("y_pred", rule)
        batches = run_batches(stream_accuracy(stream, "event_type", "event_id", "event_type", "y_pred", 200), checkpoint)
    return latest(batches).select("run", "n", "correct", "stopped")


@query("reconcile", """
    SELECT o_orderkey, 1::BIGINT AS n_truth, 0::BIGINT AS n_pred FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 101 = 5
    UNION ALL SELECT o_orderkey, 0::BIGINT, 1::BIGINT FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 101 = 5
    UNION ALL SELECT o_orderkey, 1::BIGINT, 2::BIGINT FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 5 AND o_orderkey % 103 = 7""")
def reconcile(spark, sf_dir):
    """Orders against a copy with rows lost, changed and doubled: every difference is named."""
    orders = table(spark, sf_dir, "orders")
    lost = orders.where("o_orderkey % 97 <> 0")
    changed = lost.withColumn("o_totalprice", F.when(F.expr("o_orderkey % 101 = 5"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    doubled = changed.where("o_orderkey % 103 = 7 AND o_orderkey % 101 <> 5")
    return e.reconcile(orders, changed.unionByName(doubled), "o_orderkey").select("o_orderkey", "n_truth", "n_pred")
