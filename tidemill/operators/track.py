"""Experiment tracking kept as append-only tables."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.evaluate import METRICS
from tidemill.plans.ranking import competition_rank

RUNS = "run_id string, started timestamp, experiment string"
METRIC_ROWS = "run_id string, key string, value double, step long, ts timestamp, experiment string"


class RunStore:
    """``runs`` and ``metrics`` below one folder, partitioned by experiment."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def start_run(self, experiment: str, run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        row = self.spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("started"), F.lit(experiment).alias("experiment"))
        self._append(row, "runs")
        return run_id

    def log_metrics(self, experiment: str, run_id: str, df: DataFrame) -> None:
        """Append ``key, value`` rows, with ``step`` and ``ts`` if present."""
        step = F.col("step").cast("long") if "step" in df.columns else F.lit(0).cast("long")
        ts = F.col("ts") if "ts" in df.columns else F.current_timestamp()
        self.append_metrics(df.select(
            F.lit(run_id).alias("run_id"), "key", F.col("value").cast("double").alias("value"),
            step.alias("step"), ts.alias("ts"), F.lit(experiment).alias("experiment")))

    def append_metrics(self, rows: DataFrame) -> None:
        """Append rows of many runs at once (all columns of the metrics table)."""
        self._append(rows.select("run_id", "key", "value", "step", "ts", "experiment"), "metrics")

    def autolog(self, experiment: str, run_id: str, history: DataFrame) -> None:
        """Log every metric of a training history, one step per epoch."""
        self.log_metrics(experiment, run_id, history_metrics(history))

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.path}/runs")

    def metrics(self) -> DataFrame:
        return self.spark.read.schema(METRIC_ROWS).parquet(f"{self.path}/metrics")

    def _append(self, df: DataFrame, table: str) -> None:
        df.hint("rebalance", "experiment").write.mode("append").partitionBy("experiment").parquet(f"{self.path}/{table}")


_ACTIVE: ContextVar[tuple["RunStore", str, str] | None] = ContextVar("active_run", default=None)


@contextmanager
def active_run(store: RunStore, experiment: str, run_id: str | None = None) -> Iterator[str]:
    """A run that every fit inside logs to by itself, epoch by epoch; what was logged stays if a fit dies."""
    run_id = store.start_run(experiment, run_id)
    token = _ACTIVE.set((store, experiment, run_id))
    try:
        yield run_id
    finally:
        _ACTIVE.reset(token)


def is_active() -> bool:
    return _ACTIVE.get() is not None


def report(history: DataFrame) -> None:
    """Logs rows of a history to the active run; without one, nothing happens."""
    active = _ACTIVE.get()
    if active:
        store, experiment, run_id = active
        store.autolog(experiment, run_id, history)


def history_metrics(history: DataFrame) -> DataFrame:
    """``key, value, step`` rows of a history, missing values left out."""
    present = [m for m in METRICS if m in history.columns]
    rows = history.select(F.col("epoch").cast("long").alias("step"), *present).unpivot(["step"], present, "key", "value")
    return rows.where(F.col("value").isNotNull()).select("key", "value", "step")


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The last value per experiment, run and key, by (step, ts)."""
    return metrics.groupBy("experiment", "run_id", "key").agg(F.max_by("value", F.struct("step", "ts")).alias("value"))


def compare_runs(metrics: DataFrame, key: str, lower_is_better: bool = True) -> DataFrame:
    """Rank the runs of each experiment by their best value of one metric, ties sharing a rank."""
    best = F.min("value") if lower_is_better else F.max("value")
    runs = metrics.where(F.col("key") == key).groupBy("experiment", "run_id").agg(best.alias("best"))
    return competition_rank(runs, "experiment", "best", "rank", descending=not lower_is_better)
