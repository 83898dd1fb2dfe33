"""Evaluation of a stream up to a number of samples, with running accuracy and repeats counted once."""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.plans.scratch import scratch_dir

_STORE = "spark.sql.streaming.stateStore"
#: State on disk, whose commits write changes only.
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}
RESULT = "run string, batch_n long, batch_correct long, n long, correct long, accuracy double, stopped boolean"


class Cutoff(StatefulProcessor):
    """Per run: how many samples were judged, how many rightly, and which.  At the limit a run stops; later samples change nothing."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n long, correct long")
        self.judged = handle.getMapState("judged", "id string", "correct boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, correct = self.totals.get() if self.totals.exists() else (0, 0)
        before = (n, correct)
        if n < self.limit:
            fresh: dict[str, bool] = {}
            for part in rows:
                for sample, right in zip(part["id"].tolist(), part["correct"].tolist()):
                    if sample not in fresh and not self.judged.containsKey((sample,)):
                        fresh[sample] = bool(right)
                # The smallest identifiers of a batch come first; no more of them are held than may count.
                if len(fresh) > 2 * self.limit:
                    fresh = dict(sorted(fresh.items(), key=_order)[: self.limit - n])
            for sample, right in sorted(fresh.items(), key=_order)[: self.limit - n]:
                self.judged.updateValue((sample,), (right,))
                n, correct = n + 1, correct + right
            self.totals.update((n, correct))
            if n == self.limit:
                self.judged.clear()  # nothing can be judged again, so nothing need be known
        if (n, correct) != before:
            yield pd.DataFrame([[key[0], n - before[0], correct - before[1], n, correct, correct / n, n == self.limit]], columns=[f.split(" ")[0] for f in RESULT.split(", ")])

    def close(self) -> None:
        pass


def _order(item: tuple[str, bool]) -> tuple[int, str]:
    return len(item[0]), item[0]


def _first_of_task(limit: int):
    """Keeps a task's first `limit` different samples of every run: no others can be among the first of the batch."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            length = pc.utf8_length(batch.column("id"))
            order = pc.sort_indices(pa.table({"length": length, "id": batch.column("id")}), sort_keys=[("length", "ascending"), ("id", "ascending")])
            for run, sample, right in zip(*[c.take(order).to_pylist() for c in batch.columns]):
                mine = held.setdefault(run, {})
                if sample not in mine and len(mine) < 2 * limit:
                    mine[sample] = right
            for run, mine in held.items():
                if len(mine) > limit:
                    held[run] = dict(sorted(mine.items(), key=_order)[:limit])
        for run, mine in held.items():
            names, right = list(mine), list(mine.values())
            yield pa.RecordBatch.from_arrays([pa.array([run] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(right, pa.bool_())], names=["run", "id", "correct"])

    return keep


def stream_accuracy(stream: DataFrame, run: str, key: str, y_true: str, y_pred: str, limit: int) -> DataFrame:
    """Per micro-batch and run: samples and right ones of the batch, totals so far, accuracy, whether the limit is reached.

    Counts samples, not batches.  Of a micro-batch the smallest keys come
    first (as numbers if they are of one length, shorter ones before longer);
    a key counts once, also if it comes again after a restart.  State per run
    is two numbers and, until the run stops, at most ``limit`` keys.  Before
    the shuffle every task keeps at most ``limit`` samples of a run, so a run
    of most rows is no burden to the task that judges it.  Rows without key
    take no part, a missing prediction is wrong, runs without name are one.
    """
    if limit < 1:
        raise ValueError("a limit of one sample at least")
    right = F.coalesce(F.col(y_true) == F.col(y_pred), F.lit(False))
    slim = stream.select(F.coalesce(F.col(run).cast("string"), F.lit("")).alias("run"), F.col(key).cast("string").alias("id"), right.alias("correct")).where("id IS NOT NULL")
    first = slim.mapInArrow(_first_of_task(limit), "run string, id string, correct boolean")
    return first.groupBy("run").transformWithStateInPandas(Cutoff(limit), RESULT, "Update", "none")


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Keyed state needs the disk-backed store; the session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    try:
        for k, v in STATE_SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_batches(results: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Processes all available input; the results of every micro-batch so far, with its number.

    A batch's results lie under its own number, so a repeated batch replaces
    itself; with the same checkpoint folder a stopped stream goes on.
    """
    spark = results.sparkSession
    checkpoint = (checkpoint or scratch_dir(spark, "stream")).rstrip("/")
    out = f"{checkpoint}-results"
    spark.createDataFrame([], results.schema).write.mode("overwrite").parquet(f"{out}/batch=-1")
    with state_settings(spark):
        writer = results.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")).start().awaitTermination()
    return spark.read.schema(T.StructType([*results.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)


def latest(batches: DataFrame) -> DataFrame:
    """The last totals of every run."""
    last = F.max_by(F.struct("n", "correct", "accuracy", "stopped"), "batch").alias("_last")
    return batches.groupBy("run").agg(last).select("run", "_last.*")
