from pyspark.sql import functions as F

from tidemill.operators import track
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import query, rounded, sql_round, table
from tidemill.operators.train import fit_logistic
from tidemill.queries.train import FEATURES_SQL, METRIC_COLUMNS, RULES, ZSCORES, flags, gd_fit, gd_sql, logit_sql


def event_metrics(spark, sf_dir):
    """Events as metrics: experiment = type, run = user, step = event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"), F.col("user_id").cast("string").alias("run_id"), F.lit("value").alias("key"),
        "value", F.col("event_id").alias("step"), F.col("ts").cast("timestamp").alias("ts"))


@query("logged_metrics", """
    SELECT event_type AS experiment, count(*)::BIGINT AS n, max(event_id)::BIGINT AS last_step FROM events GROUP BY 1""")
def logged_metrics(spark, sf_dir):
    """A run store filled with every event and read back."""
    store = track.RunStore(spark, scratch_dir(spark, "runs"))
    store.append_metrics(event_metrics(spark, sf_dir))
    return store.metrics().groupBy("experiment").agg(F.count(F.lit(1)).alias("n"), F.max("step").alias("last_step"))


@query("autolog_rows", gd_sql(10, True) + """
    SELECT 'trend' AS experiment, epoch::BIGINT AS step, 'loss' AS key, loss AS value FROM h
    UNION ALL SELECT 'trend', epoch::BIGINT, 'val_loss', val_loss FROM h""")
def autolog_rows(spark, sf_dir):
    """A fit's history logged without naming its metrics."""
    store = track.RunStore(spark, scratch_dir(spark, "runs"))
    _, history = gd_fit(spark, sf_dir, 10, split="split")
    store.autolog("trend", store.start_run("trend"), history)
    return store.metrics().select("experiment", "step", "key", rounded(F.col("value")).alias("value"))


@query("latest_metric", """
    SELECT event_type AS experiment, user_id::VARCHAR AS run_id, 'value' AS key, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def latest_metric(spark, sf_dir):
    return track.latest_metrics(event_metrics(spark, sf_dir))


@query("compare_runs", """
    WITH b AS (SELECT event_type AS experiment, user_id::VARCHAR AS run_id, max(value) AS best FROM events GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY experiment ORDER BY best DESC)::BIGINT AS rank FROM b""")
def compare_runs(spark, sf_dir):
    """Users of each event type ranked by their largest value."""
    return track.compare_runs(event_metrics(spark, sf_dir), "value", lower_is_better=False)


@query("autolog_run", f"""
    WITH {FEATURES_SQL}, {logit_sql('adam', 2)}, u AS (UNPIVOT adam_h ON {', '.join(METRIC_COLUMNS)} INTO NAME name VALUE value)
    SELECT 'flags' AS experiment, name AS key, epoch::BIGINT AS step, {sql_round('value')} AS value FROM u""")
def autolog_run(spark, sf_dir):
    """A fit inside an active run: its epochs are in the store without a call."""
    store = track.RunStore(spark, scratch_dir(spark, "runs"))
    with track.active_run(store, "flags"):
        fit_logistic(flags(spark, sf_dir), ZSCORES, "y", 2, RULES["adam"], split="split")
    return store.metrics().select("experiment", "key", "step", rounded(F.col("value")).alias("value"))
