from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.optimizers import Optimizer
from tidemill.operators import train as t
from tidemill.operators.evaluate import confusion_counts, confusion_grid, curves
from tidemill.operators.score import score_dense
from tidemill.operators.split import hash_split
from tidemill.operators.transform import apply_array_scaler, apply_scaler, argmax_class, fit_array_scaler, fit_scaler
from tidemill.plans.iterate import kept
from tidemill.plans.scratch import scratch_dir
from tidemill.queries.registry import query, rounded, sql_round, sql_split, table
from tidemill.sources.synthetic import sample_points

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
RULES = {"sgd": Optimizer("sgd", 0.1, 0.9), "adam": Optimizer("adam", 0.01), "rmsprop": Optimizer("rmsprop", 0.01)}


def two_rates(epoch: int, lr: float) -> float:
    """The trend fit's schedule: 0.001, then 0.0001 from epoch 50."""
    return 0.0001 if epoch >= 50 else 0.001


def trend(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 0)
    return orders.select("o_orderkey", "o_orderpriority", "o_totalprice", F.year("o_orderdate").alias("year"),
                         (F.year("o_orderdate") - 1998).alias("x"), F.ln("o_totalprice").alias("y"))


@query("fit_line", f"""
    SELECT o_orderpriority, {sql_round('regr_slope(y, x)')} AS slope, {sql_round('regr_intercept(y, x)')} AS intercept,
           {sql_round('regr_r2(y, x)')} AS r2, count(*)::BIGINT AS n
    FROM (SELECT o_orderpriority, year(o_orderdate)::INT - 1998 AS x, ln(o_totalprice) AS y FROM orders WHERE o_totalprice > 0) GROUP BY 1""")
def fit_line(spark, sf_dir):
    fit = t.fit_line(trend(spark, sf_dir), "x", "y", "o_orderpriority")
    return fit.select("o_orderpriority", *[rounded(F.col(c)).alias(c) for c in ("slope", "intercept", "r2")], "n")


@query("doubling_time", f"""
    SELECT o_orderpriority, {sql_round('ln(2) / regr_slope(ln(o_totalprice), year(o_orderdate)::INT)', 2)} AS doubling_time, count(*)::BIGINT AS n
    FROM orders WHERE o_totalprice > 0 GROUP BY 1""")
def doubling_time(spark, sf_dir):
    fit = t.doubling_time(trend(spark, sf_dir), "year", "o_totalprice", "o_orderpriority")
    return fit.select("o_orderpriority", rounded(F.col("doubling_time"), 2).alias("doubling_time"), "n")


def gd_sql(epochs: int, validation: bool) -> str:
    """Momentum descent replayed over the same sums by a recursive query."""
    side = sql_split("o_orderkey", 0.2) if validation else "'train'"
    sums = "count(*)::DOUBLE n, sum(x)::DOUBLE sx, sum(x * x)::DOUBLE sxx, sum(y) sy, sum(x * y) sxy, sum(y * y) syy"

    def mse(a: str, w: str, b: str) -> str:
        return f"(({w} * {w} * {a}.sxx + 2 * {w} * {b} * {a}.sx + {b} * {b} * {a}.n) - 2 * ({w} * {a}.sxy + {b} * {a}.sy) + {a}.syy) / {a}.n"

    step_v = "0.9::DOUBLE * gd.vw - lr * 2 / t.n * (gd.w * t.sxx + gd.b * t.sx - t.sxy)"
    step_b = "0.9::DOUBLE * gd.vb - lr * 2 / t.n * (gd.w * t.sx + gd.b * t.n - t.sy)"
    val = sql_round(mse("v", "g.nw", "g.nb")) if validation else "NULL::DOUBLE"
    return f"""
    WITH RECURSIVE d AS (SELECT {side} AS split, (year(o_orderdate) - 1998)::DOUBLE AS x, ln(o_totalprice) AS y FROM orders WHERE o_totalprice > 0),
    t AS (SELECT {sums} FROM d WHERE split = 'train'), v AS (SELECT {sums} FROM d WHERE split = 'validation'),
    gd(epoch, w, b, vw, vb, loss, lr, nw, nb) AS (
      SELECT -1, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0.001::DOUBLE, 0::DOUBLE, 0::DOUBLE
      UNION ALL
      SELECT epoch, w + nvw, b + nvb, nvw, nvb, loss, lr, w + nvw, b + nvb FROM (
        SELECT gd.epoch + 1 AS epoch, gd.w, gd.b, {step_v} AS nvw, {step_b} AS nvb, {mse('t', 'gd.w', 'gd.b')} AS loss, lr
        FROM (SELECT epoch, w, b, vw, vb, CASE WHEN epoch + 1 >= 50 THEN 0.0001::DOUBLE ELSE 0.001::DOUBLE END AS lr FROM gd) gd, t WHERE gd.epoch + 1 < {epochs})),
    h AS (SELECT g.epoch::INT AS epoch, lr, {sql_round('g.loss')} AS loss, {val} AS val_loss FROM gd g, v WHERE g.epoch >= 0)"""


def gd_fit(spark, sf_dir, epochs, split=None):
    data = trend(spark, sf_dir)
    data = hash_split(data, "o_orderkey", 0.2) if split else data
    return t.fit_linear_gd(data, "x", "y", epochs, steps=1, schedule=two_rates, split=split)


@query("gd_history", gd_sql(100, False) + " SELECT epoch, lr, loss FROM h")
def gd_history(spark, sf_dir):
    """100 epochs of momentum descent from a single aggregation."""
    _, history = gd_fit(spark, sf_dir, 100)
    return history.select("epoch", "lr", rounded(F.col("loss")).alias("loss"))


def _rule_step(rule: str, i: int, step: int) -> tuple[str, str, str]:
    """SQL for one weight's update: new weight, new first and second slot."""
    g, lr = f"g{i}", f"{RULES[rule].lr}::DOUBLE"
    if rule == "sgd":
        v = f"(0.9::DOUBLE * a{i} - {lr} * {g})"
        return f"w{i} + {v}", v, "0::DOUBLE"
    if rule == "adam":
        m = f"(0.9::DOUBLE * a{i} + (1 - 0.9::DOUBLE) * {g})"
        v = f"(0.999::DOUBLE * b{i} + (1 - 0.999::DOUBLE) * {g} * {g})"
        rate = f"({lr} * sqrt(1 - pow(0.999::DOUBLE, {step})) / (1 - pow(0.9::DOUBLE, {step})))"
        return f"w{i} - {rate} * {m} / (sqrt({v}) + 1e-7::DOUBLE)", m, v
    v = f"(0.9::DOUBLE * a{i} + (1 - 0.9::DOUBLE) * {g} * {g})"
    return f"w{i} - {lr} * {g} / sqrt({v} + 1e-7::DOUBLE)", v, "0::DOUBLE"


FEATURES_SQL = f"""
    d0 AS (SELECT {sql_split('l_orderkey', 0.2)} AS split, (l_returnflag = 'R')::INT::DOUBLE AS y, {', '.join(NUMERIC)} FROM lineitem),
    st AS (SELECT {', '.join(f'avg({c}) AS m{i}, stddev_pop({c}) AS s{i}' for i, c in enumerate(NUMERIC))} FROM d0 WHERE split = 'train'),
    d AS MATERIALIZED (SELECT split = 'validation' AS val, y, {', '.join(f'({c} - m{i}) / s{i} AS x{i}' for i, c in enumerate(NUMERIC))} FROM d0, st)"""


def logit_sql(rule: str, epochs: int, k: int = len(NUMERIC)) -> str:
    """One chain of queries per epoch: sums at the weights of k features, then the update."""
    every = range(k + 1)
    zeros = ", ".join(f"0::DOUBLE AS w{i}, 0::DOUBLE AS a{i}, 0::DOUBLE AS b{i}" for i in every)
    parts = [f"{rule}_w0 AS (SELECT {zeros})"]
    z = " + ".join([*[f"w{i} * x{i}" for i in range(k)], f"w{k}"])
    p = "least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)"
    gradients = ", ".join([*[f"sum((p - y) * x{i}) / count(*) AS g{i}" for i in range(k)], f"sum(p - y) / count(*) AS g{k}"])
    for e in range(epochs + 1):
        parts.append(f"""{rule}_p{e} AS MATERIALIZED (SELECT val, avg(-(y * ln({p}) + (1 - y) * ln(1 - {p}))) AS loss, avg(((p > 0.5)::INT = y)::INT) AS accuracy, {gradients}
            FROM (SELECT d.*, 1 / (1 + exp(-({z}))) AS p FROM d, {rule}_w{e}) GROUP BY val)""")
        if e < epochs:
            steps = [_rule_step(rule, i, e + 1) for i in every]
            updated = ", ".join(f"{w} AS w{i}, {a} AS a{i}, {b} AS b{i}" for i, (w, a, b) in enumerate(steps))
            parts.append(f"{rule}_w{e + 1} AS MATERIALIZED (SELECT {updated} FROM {rule}_w{e}, {rule}_p{e} WHERE NOT val)")
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {e}::INT AS epoch, t.loss, v.loss AS val_loss, t.accuracy, v.accuracy AS val_accuracy "
        f"FROM {rule}_p{e} t, {rule}_p{e + 1} v WHERE NOT t.val AND v.val" for e in range(epochs))
    parts.append(f"{rule}_h AS ({rows})")
    return ",\n".join(parts)


METRIC_COLUMNS = ["loss", "val_loss", "accuracy", "val_accuracy"]
ROUNDED_METRICS = ", ".join(f"{sql_round(c)} AS {c}" for c in METRIC_COLUMNS)


def flags(spark, sf_dir):
    """Standardised numeric columns with label ``l_returnflag = 'R'``."""
    items = hash_split(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *NUMERIC), "l_orderkey", 0.2)
    items = items.withColumn("y", (F.col("l_returnflag") == "R").cast("double"))
    scaled = apply_scaler(items, fit_scaler(items.where(F.col("split") == "train"), NUMERIC), NUMERIC, "_z")
    return scaled.select("split", "y", *ZSCORES)


ZSCORES = [f"{c}_z" for c in NUMERIC]


def round_metrics(history):
    return history.withColumns({c: rounded(F.col(c)) for c in METRIC_COLUMNS}).drop("lr")


@query("logit_history", f"""
    WITH {FEATURES_SQL}, {', '.join(logit_sql(r, 3) for r in RULES)}
    SELECT rule, epoch, {ROUNDED_METRICS} FROM ({' UNION ALL '.join(f'SELECT * FROM {r}_h' for r in RULES)})""")
def logit_history(spark, sf_dir):
    """Three epochs of logistic descent under each update rule."""
    with kept(flags(spark, sf_dir)) as data:
        parts = [t.fit_logistic(data, ZSCORES, "y", 3, rule, split="split")[1].withColumn("rule", F.lit(name)) for name, rule in RULES.items()]
    return round_metrics(reduce(DataFrame.unionByName, parts))


@query("logit_resume", f"""
    WITH {FEATURES_SQL}, {logit_sql('adam', 3)} SELECT epoch, {ROUNDED_METRICS} FROM adam_h""")
def logit_resume(spark, sf_dir):
    """One epoch, saved, loaded and continued for two more: the same as three."""
    rule, path = RULES["adam"], scratch_dir(spark, "state")
    with kept(flags(spark, sf_dir)) as data:
        state, first = t.fit_logistic(data, ZSCORES, "y", 1, rule, split="split")
        t.save_state(spark, state, path)
        _, rest = t.resume(t.fit_logistic, t.load_state(spark, path), data, ZSCORES, "y", 2, rule, split="split")
    return round_metrics(first.unionByName(rest))


@query("curves", f"""
    WITH {FEATURES_SQL}, {logit_sql('adam', 2)}, u AS (UNPIVOT adam_h ON {', '.join(METRIC_COLUMNS)} INTO NAME name VALUE value)
    SELECT epoch, CASE WHEN name LIKE '%accuracy' THEN 'accuracy' ELSE 'loss' END AS metric,
           CASE WHEN name LIKE 'val%' THEN 'validation' ELSE 'train' END AS phase, {sql_round('value')} AS value, true AS available FROM u""")
def training_curves(spark, sf_dir):
    _, history = t.fit_logistic(flags(spark, sf_dir), ZSCORES, "y", 2, RULES["adam"], split="split")
    return curves(history).withColumn("value", rounded(F.col("value")))


def vectors(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return hash_split(v, "vec_id", 0.2)


@query("softmax_head")
def softmax_head(spark, sf_dir):
    """The whole lifecycle on frozen features: split, scale, fit a head, score, confusion grid of the validation side."""
    data = vectors(spark, sf_dir)
    stats = fit_array_scaler(data.where(F.col("split") == "train"), "embedding")
    scaled = apply_array_scaler(data, stats, "embedding")
    head = t.fit_softmax_head(scaled.where(F.col("split") == "train"), "embedding", "label", 10)
    held_out = scaled.where(F.col("split") == "validation").select(F.col("label").alias("y_true"), "embedding")
    scored = argmax_class(score_dense(held_out, head.layers, "embedding"))
    return confusion_grid(confusion_counts(scored), range(10))


@query("softmax_optimum", f"""
    SELECT DISTINCT label::INT AS class, 0.0::DOUBLE AS slope, true AS better
    FROM (SELECT label, {sql_split('vec_id', 0.2)} AS split FROM embeddings) WHERE split = 'train' AND label IS NOT NULL""")
def softmax_optimum(spark, sf_dir):
    """The loss is convex, so a head is right exactly where every slope of it vanishes: per class the steepest one, and whether the loss beats class shares."""
    data = vectors(spark, sf_dir).where(F.col("split") == "train")
    head = t.fit_softmax_head(data, "embedding", "label", 10, max_iter=500)
    scored = score_dense(data.select("label", "embedding"), head.layers, "embedding")
    scored = scored.select("label", F.array_append("embedding", F.lit(1.0)).alias("x"), F.posexplode("probs").alias("class", "p"))
    own = F.col("label") == F.col("class")
    error = scored.select("class", (F.col("p") - own.cast("double")).alias("e"), "x", F.when(own, -F.ln("p")).alias("loss"))
    slopes = error.select("class", "e", F.posexplode("x").alias("pos", "v")).groupBy("class", "pos").agg(F.avg(F.col("e") * F.col("v")).alias("slope"))
    steepest = slopes.groupBy("class").agg(rounded(F.max(F.abs("slope")), 2).alias("slope"))
    shares = error.groupBy("class").agg(F.count("loss").alias("n"), F.sum("loss").alias("loss"))
    judged = shares.agg(F.sum("n").alias("all"), F.sum("loss").alias("loss"), F.sum(F.col("n") * F.ln(F.greatest("n", F.lit(1)))).alias("logs"))
    better = judged.select(F.col("loss") < F.col("all") * F.ln("all") - F.col("logs"))
    seen = shares.where("n > 0").select("class")
    return steepest.join(seen, "class", "left_semi").withColumn("better", better.scalar())


@query("dense_regression")
def dense_regression(spark, sf_dir):
    """A hidden layer fitted to a surface sampled at one point per order."""
    points = sample_points(table(spark, sf_dir, "orders"), "o_orderkey", -3.0, 3.0, seed=7)
    points = hash_split(points.withColumn("x", F.array("x1", "x2")), "o_orderkey", 0.2)
    _, history = t.fit_dense(points, "o_orderkey", "x", "y", [128], "mse", 10, optimizer=Optimizer("adam", 0.01), split="split")
    return history


@query("dense_classify")
def dense_classify(spark, sf_dir):
    """64-128-10 network with dropout on the vectors."""
    _, history = t.fit_dense(vectors(spark, sf_dir), "vec_id", "embedding", "label", [128], "sparse_ce", 10, outputs=10,
                             optimizer=Optimizer("adam", 0.01), dropout=0.2, split="split")
    return history
