"""

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_ONLY (comma-separated names) steer it.  Each entry is one timed run
after one warm-up, results written to Spark's noop sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemill.functions import dense  # noqa: E402
from tidemill.operators import evaluate, score, split, train, transform  # noqa: E402
from tidemill.queries import QUERIES  # noqa: E402
from tidemill.queries.registry import table  # noqa: E402
from tidemill.queries.score import fixed_head  # noqa: E402
from tidemill.queries.train import NUMERIC, RULES  # noqa: E402
from tidemill.session import local_session  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def probes(spark, sf_dir) -> dict:
    """The same shapes as the baseline's probes, on the same cached inputs."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", *NUMERIC)
    items = items.withColumn("y", (F.col("l_returnflag") == "R").cast("double")).repartition(8).cache()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("copy"))
    vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")).repartition(8).cache()
    points = table(spark, sf_dir, "orders").cache()
    for frame in (items, vectors, points):
        frame.count()
    unique = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    head = fixed_head()

    def forward():
        layers = head
        return vectors.select("embedding").mapInArrow(_argmax(layers), "y_pred int")

    def _argmax(layers):
        import numpy as np
        import pyarrow as pa

        def run(batches):
            for b in batches:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(dense.predict(layers, x, "linear").argmax(axis=1).astype(np.int32))], names=["y_pred"])

        return run

    return {
        "probe_logit_epoch": lambda: train.fit_logistic(items, NUMERIC, "y", 1, RULES["sgd"])[1],
        "probe_forward_argmax": forward,
        "probe_forward_probs": lambda: score.score_dense(vectors.select("embedding"), head, "embedding").select("probs"),
        "probe_row_number": lambda: split.global_row_number(items.select(*unique), unique),
        "probe_standardize": lambda: transform.apply_scaler(items.select("l_quantity"), transform.fit_scaler(items, "l_quantity"), "l_quantity"),
        "probe_pair_counts": lambda: evaluate.confusion_counts(items, "l_returnflag", "l_linestatus"),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g", app="bench")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    jobs = {name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in QUERIES.items()}
    jobs.update(probes(spark, sf_dir))
    times = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        consume(job())
        start = time.perf_counter()
        consume(job())
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
