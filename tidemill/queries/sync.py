"""Epoch orders without a shuffle and mini-batches that all workers take together."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import dense
from tidemill.functions.optimizers import Optimizer
from tidemill.operators import augment, split
from tidemill.operators.sync import Augmentation, fit_synchronous
from tidemill.operators.train import load_state, resume, save_state
from tidemill.plans.permute import PRIME, ROUNDS, Permutation
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import query, rounded, sql_round, sql_split, sql_u32, table
from tidemill.sources.synthetic import sample_points

#: Walks the SQL takes through the network; more than a permutation of the test tables needs.
SQL_WALKS = 6


def sql_positions(source: str, key: str) -> str:
    """SELECT * with ``place``, the permuted ``zero`` (0..n-1); the source has the columns zero and n."""
    rows, columns = "ceil(sqrt(n))::BIGINT", "((n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT)"
    out = f"SELECT *, zero AS cell, {rows} AS gr, {columns} AS gc FROM ({source})"
    for walk in range(SQL_WALKS):
        out = f"SELECT *, cell // gc AS hl, cell % gc AS hr FROM ({out})"
        for turn in range(ROUNDS):
            a, b, c, d = Permutation(0, key).constants(turn)
            moved, by, size = ("hl", "hr", "gr") if turn % 2 == 0 else ("hr", "hl", "gc")
            out = f"SELECT *, ({by} * {a} + {b}) % {PRIME} AS u FROM ({out})"
            out = f"SELECT * EXCLUDE u, (xor(u, u >> 15) * {c} + {d}) % {PRIME} AS u FROM ({out})"
            out = f"SELECT * REPLACE (({moved} + xor(u, u >> 13)) % {size} AS {moved}) FROM ({out})"
            out = f"SELECT * EXCLUDE u FROM ({out})"
        there = "hl * gc + hr" if walk == 0 else "CASE WHEN cell < n THEN cell ELSE hl * gc + hr END"
        out = f"SELECT * EXCLUDE (cell, hl, hr), {there} AS cell FROM ({out})"
    return f"SELECT * EXCLUDE (cell, gr, gc), cell AS place FROM ({out})"


def sql_zero(key: str, seed) -> str:
    """The rank from 0 in digest order."""
    return f"row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key}) - 1"


RANKED_SQL = f"SELECT o_orderkey, {sql_zero('o_orderkey', 0)} AS zero, count(*) OVER () AS n FROM orders"


def _ranked(spark, sf_dir) -> tuple[DataFrame, int]:
    """Orders ranked once and written, so that an epoch reads ranks instead of making them."""
    path = scratch_dir(spark, "ranked")
    split.global_row_number(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").write.parquet(path)
    ranked = spark.read.parquet(path)
    return ranked, ranked.count()


@query("epoch_orders", " UNION ALL ".join(
    f"SELECT o_orderkey, {e}::INT AS epoch, place + 1 AS position FROM ({sql_positions(RANKED_SQL, f'42:{e}')})" for e in range(3)))
def epoch_orders(spark, sf_dir):
    """Three sample orders from one ranking: no shuffle after the first."""
    ranked, n = _ranked(spark, sf_dir)
    parts = [split.epoch_order(ranked, n, 42, e).select("o_orderkey", F.lit(e).alias("epoch"), "position") for e in range(3)]
    return reduce(DataFrame.unionByName, parts)


@query("epoch_batches", f"""
    SELECT o_orderkey, (place // 32)::BIGINT AS batch_id, (place % 32)::INT AS pos FROM ({sql_positions(RANKED_SQL, '42:5')}) WHERE place < n // 32 * 32""")
def epoch_batches(spark, sf_dir):
    """Whole mini-batches of a later epoch, from the same ranking."""
    ranked, n = _ranked(spark, sf_dir)
    return split.epoch_batches(ranked, n, 32, 42, 5).select("o_orderkey", "batch_id", "pos")


def replay_sql(rows: str, widths: list[int], output: str, rule: Optimizer, epochs: int, batch: int, seed: int = 42) -> str:
    """Mini-batch descent of a network of two inputs and at most one hidden layer, step by step in a recursive query.

    ``rows`` has key, split, x1, x2, y.  Every step sums the gradient over its batch.
    """
    start = dense.glorot(widths, seed)
    m = widths[1] if len(widths) == 3 else 0
    params = len(start)
    if m:
        hidden = [f"greatest(x1 * w{j} + x2 * w{m + j} + w{2 * m + j}, 0)" for j in range(m)]
        z = " + ".join([*[f"h{j} * w{3 * m + j}" for j in range(m)], f"w{4 * m}"])
        parts = [*[f"e * w{3 * m + j} * (h{j} > 0)::INT * x1" for j in range(m)], *[f"e * w{3 * m + j} * (h{j} > 0)::INT * x2" for j in range(m)],
                 *[f"e * w{3 * m + j} * (h{j} > 0)::INT" for j in range(m)], *[f"e * h{j}" for j in range(m)], "e"]
    else:
        hidden, z, parts = [], "x1 * w0 + x2 * w1 + w2", ["e * x1", "e * x2", "e"]
    p = "z" if output == "linear" else "1 / (1 + exp(-z))"
    clipped = "least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)"
    loss = "(p - y) * (p - y)" if output == "linear" else f"-(y * ln({clipped}) + (1 - y) * ln(1 - {clipped}))"
    error = "2 * (p - y)" if output == "linear" else "p - y"
    w, a, b = ([f"{c}{i}" for i in range(params)] for c in "wab")
    keep = ", ".join([*w, *a, *b])

    def forward(source: str) -> str:
        out = f"SELECT *{''.join(f', {h} AS h{j}' for j, h in enumerate(hidden))} FROM ({source})"
        out = f"SELECT *, {p} AS p FROM (SELECT *, {z} AS z FROM ({out}))"
        return f"SELECT *, {loss} AS loss, {error} AS e, ((p > 0.5)::INT = y)::INT AS hit FROM ({out})"

    def update(i: int) -> tuple[str, str, str]:
        g, lr = f"g{i}", f"{rule.lr}::DOUBLE"
        if rule.name == "sgd":
            v = f"({rule.momentum}::DOUBLE * a{i} - {lr} * {g})"
            return f"w{i} + {v}", v, "0::DOUBLE"
        first, second = f"(0.9::DOUBLE * a{i} + (1 - 0.9::DOUBLE) * {g})", f"(0.999::DOUBLE * b{i} + (1 - 0.999::DOUBLE) * {g} * {g})"
        rate = f"({lr} * sqrt(1 - pow(0.999::DOUBLE, s + 1)) / (1 - pow(0.9::DOUBLE, s + 1)))"
        return f"w{i} - {rate} * {first} / (sqrt({second}) + 1e-7::DOUBLE)", first, second

    steps = ", ".join(f"{x} AS w{i}, {y} AS a{i}, {v} AS b{i}" for i in range(params) for x, y, v in [update(i)])
    zeros = ", ".join(f"{float(start[i])!r}::DOUBLE AS w{i}, 0::DOUBLE AS a{i}, 0::DOUBLE AS b{i}" for i in range(params))
    order = " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM ({sql_positions('SELECT * FROM ranked', f'{seed}:{e}')})" for e in range(epochs))
    return f"""
    WITH RECURSIVE d AS MATERIALIZED ({rows}),
    ranked AS MATERIALIZED (SELECT x1, x2, y, {sql_zero('key', seed)} AS zero, count(*) OVER () AS n FROM d WHERE split = 'train'),
    b AS MATERIALIZED (SELECT x1, x2, y, epoch * ((n + {batch - 1}) // {batch}) + place // {batch} + 1 AS step, (n + {batch - 1}) // {batch} AS per FROM ({order})),
    st AS (
      SELECT 0::BIGINT AS s, 0::DOUBLE AS loss, 0::DOUBLE AS hits, 0::DOUBLE AS m, {zeros}
      UNION ALL
      SELECT s + 1, loss, hits, m, {steps} FROM (
        SELECT s, sum(l) AS loss, sum(hit)::DOUBLE AS hits, count(*)::DOUBLE AS m, {', '.join(f'sum({g}) / count(*) AS g{i}' for i, g in enumerate(parts))}, {keep}
        FROM (SELECT * RENAME (loss AS l) FROM ({forward(f"SELECT s, {keep}, x1, x2, y FROM st JOIN b ON b.step = st.s + 1")})) GROUP BY s, {keep})),
    per AS (SELECT max(per) AS per FROM b),
    t AS (SELECT ((s - 1) // per)::INT AS epoch, sum(loss) / sum(m) AS loss, sum(hits) / sum(m) AS accuracy FROM st, per WHERE s > 0 GROUP BY 1),
    v AS (SELECT (s // per - 1)::INT AS epoch, avg(loss) AS val_loss, avg(hit) AS val_accuracy FROM ({forward(f"SELECT s, per, {keep}, x1, x2, y FROM st, per, d WHERE split = 'validation' AND s > 0 AND s % per = 0")}) GROUP BY 1)
    SELECT t.epoch, {sql_round('loss')} AS loss, {sql_round('val_loss')} AS val_loss, {sql_round('accuracy') if output != 'linear' else 'NULL::DOUBLE'} AS accuracy,
           {sql_round('val_accuracy') if output != 'linear' else 'NULL::DOUBLE'} AS val_accuracy FROM t JOIN v USING (epoch)"""


def _rounded(history: DataFrame) -> DataFrame:
    return history.drop("lr").withColumns({c: rounded(F.col(c)) for c in ("loss", "val_loss", "accuracy", "val_accuracy")})


SURFACE_SQL = f"""
    SELECT o_orderkey AS key, {sql_split('o_orderkey', 0.2)} AS split, x1, x2, cos(2 * x1) + cos(3 * x2) AS y FROM (
        SELECT o_orderkey, -3 + 6 * ({sql_u32('7:x1', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x1, -3 + 6 * ({sql_u32('7:x2', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x2 FROM orders)"""


@query("dense_history", replay_sql(SURFACE_SQL, [2, 3, 1], "linear", Optimizer("adam", 0.01), 3, 256))
def dense_history(spark, sf_dir):
    """A 2-3-1 network in synchronous mini-batches, each step the same as on one machine."""
    points = sample_points(table(spark, sf_dir, "orders"), "o_orderkey", -3.0, 3.0, seed=7)
    sides = split.hash_split(points, "o_orderkey", 0.2)
    _, history = fit_synchronous(sides, "o_orderkey", ["x1", "x2"], "y", [3], "mse", 3, optimizer=Optimizer("adam", 0.01), batch=256, workers=4, split="split")
    return _rounded(history)


STATUS_SQL = f"""
    SELECT o_orderkey AS key, {sql_split('o_orderkey', 0.2)} AS split, (year(o_orderdate) - 1998) / 2.0::DOUBLE AS x1, o_totalprice / 100000.0::DOUBLE AS x2, (o_orderpriority < '3')::INT::DOUBLE AS y FROM orders"""


@query("logit_batches", replay_sql(STATUS_SQL, [2, 1], "sigmoid", Optimizer("sgd", 0.05, 0.9), 2, 512))
def logit_batches(spark, sf_dir):
    """A sigmoid unit in mini-batches: the fit of the tabular notebook."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", ((F.year("o_orderdate") - 1998) / 2.0).alias("x1"), (F.col("o_totalprice") / 100000.0).alias("x2"), (F.col("o_orderpriority") < "3").cast("int").alias("y"))
    sides = split.hash_split(orders, "o_orderkey", 0.2)
    _, history = fit_synchronous(sides, "o_orderkey", ["x1", "x2"], "y", [], "binary_ce", 2, optimizer=Optimizer("sgd", 0.05, 0.9), batch=512, workers=4, split="split")
    return _rounded(history)


@query("augmented_resume", """
    SELECT epoch::INT AS epoch, count(*) FILTER (label IS NOT NULL AND embedding IS NOT NULL)::BIGINT AS n, 0.0::DOUBLE AS loss_gap, 0.0::DOUBLE AS weight_gap
    FROM embeddings, range(2) e(epoch) GROUP BY 1""")
def augmented_resume(spark, sf_dir):
    """Vectors as 8x8 images, drawn anew in each epoch's pass; the first epoch saved, the second resumed.  The gaps are to a fit on variants written out."""
    images = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<float>").alias("pixels"))
    common = ("vec_id", "pixels", "label", [], "sparse_ce", 1)
    options = dict(outputs=10, optimizer=Optimizer("sgd", 0.1, 0.9), batch=256, workers=4)
    drawn = written = None
    rows = []
    for epoch in range(2):
        path = scratch_dir(spark, "state")
        if drawn is None:
            drawn, one = fit_synchronous(images, *common, augment=Augmentation(8, 8), **options)
        else:
            drawn, one = resume(fit_synchronous, drawn, images, *common, augment=Augmentation(8, 8), **options)
        save_state(spark, drawn, path)
        drawn = load_state(spark, path)
        variants = augment.affine(augment.augment_plan(images, "vec_id", 1, seed=f"42:{epoch}"), 8, 8, 1)
        written, other = fit_synchronous(variants, *common, initial=written, **options)
        gap = rounded(F.abs(F.col("loss") - F.lit(other.first().loss)))
        rows.append(one.select("epoch", F.lit(variants.where("label IS NOT NULL AND pixels IS NOT NULL").count()).cast("long").alias("n"), gap.alias("loss_gap"), F.lit(round(float(abs(drawn.weights - written.weights).max()), 6) + 0.0).alias("weight_gap")))
    return rows[0].unionByName(rows[1])
