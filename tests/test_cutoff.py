"""First-n evaluation of a stream over several micro-batches, repeats and a restart."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemill.streaming.confusion import stream_table
from tidemill.streaming.cutoff import latest, run_batches, stream_accuracy

SCHEMA = "run string, id long, y_true int, y_pred int"


def expected(batches, limit):
    """Run by run, batch by batch, in key order."""
    out, known = [], defaultdict(dict)
    for number, rows in enumerate(batches):
        fresh = defaultdict(dict)
        for run, key, t, p in rows:
            if key is not None:
                fresh[run or ""].setdefault(key, t is not None and t == p)
        for run, found in fresh.items():
            before = len(known[run])
            new = [(k, v) for k, v in sorted(found.items()) if k not in known[run]][: limit - before]
            known[run].update(new)
            if new:
                n, right = len(known[run]), sum(known[run].values())
                out.append((number, run, len(new), sum(v for _, v in new), n, right, right / n, n == limit))
    return sorted(out)


def rows_of(start, stop, runs=("a", "b"), wrong=3):
    return [(r, i, 1, 0 if i % wrong == 0 else 1) for r in runs for i in range(start, stop)]


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).sortWithinPartitions(F.desc("id")).coalesce(1).write.mode("append").parquet(folder)


def test_batches_repeats_and_a_restart_equal_the_plain_answer(spark, fresh):
    folder, checkpoint = fresh("input"), fresh("checkpoint")
    schema = spark.createDataFrame([], SCHEMA).schema
    parts = [
        rows_of(0, 12) + rows_of(0, 5) + [(None, 1, 1, 1), ("a", None, 1, 1), ("c", 7, 1, None)],
        rows_of(8, 20, ("a",)) + rows_of(0, 12, ("b",)),
        rows_of(0, 60, wrong=2),
        rows_of(100, 130, ("b", "c")),
    ]

    def go():
        stream = stream_table(spark, folder, schema, files_per_trigger=1)
        return run_batches(stream_accuracy(stream, "run", "id", "y_true", "y_pred", 25), checkpoint)

    for part in parts[:2]:
        write(spark, folder, part)
    go()
    for part in parts[2:]:
        write(spark, folder, part)
    batches = go()
    columns = ["batch", "run", "batch_n", "batch_correct", "n", "correct", "accuracy", "stopped"]
    want = expected(parts, 25)
    assert sorted(tuple(r) for r in batches.select(*columns).collect()) == want
    last = {run: w for w in want for run in [w[1]]}
    assert {r.run: (r.n, r.correct, r.stopped) for r in latest(batches).collect()} == {k: (w[4], w[5], w[7]) for k, w in last.items()}


def test_settings_come_back_and_a_limit_is_needed(spark):
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")
    with pytest.raises(ValueError):
        stream_accuracy(spark.createDataFrame([], SCHEMA), "run", "id", "y_true", "y_pred", 0)
