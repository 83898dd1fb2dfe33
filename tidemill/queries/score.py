import numpy as np
from pyspark.sql import functions as F

from tidemill.functions.optimizers import Optimizer
from tidemill.operators import score as s
from tidemill.operators.split import hash_split
from tidemill.operators.train import fit_linear_gd
from tidemill.operators.transform import apply_scaler, fit_scaler
from tidemill.queries.registry import per_position, query, rounded, sql_round, sql_split, sql_u32, table
from tidemill.sources.synthetic import sample_points

FLAT = "SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings"


def fixed_head(dim: int = 64, classes: int = 10):
    """w[i, j] = (((7 i + 13 j) mod 11) - 5) / 10, b[j] = (j - 4.5) / 10."""
    i, j = np.meshgrid(np.arange(dim), np.arange(classes), indexing="ij")
    return [(((7 * i + 13 * j) % 11 - 5) / 10.0, (np.arange(classes) - 4.5) / 10.0)]


@query("score_dense", f"""
    WITH e AS ({FLAT}),
    z AS (SELECT vec_id, j, exp(sum(v * (((7 * i + 13 * j) % 11 - 5) / 10.0::DOUBLE)) + (j - 4.5::DOUBLE) / 10) AS s FROM e, range(10) r(j) GROUP BY vec_id, j)
    SELECT vec_id, j::INT AS pos, {sql_round('s / sum(s) OVER (PARTITION BY vec_id)')} AS value FROM z""")
def score_dense(spark, sf_dir):
    """Class probabilities of every vector under a fixed layer."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return per_position(s.score_dense(vectors, fixed_head(), "embedding").drop("embedding"), ["vec_id"], "probs", 6)


@query("frozen_features", f"""
    WITH e AS ({FLAT}), w AS (SELECT i, j, {sql_u32(42, '(i * 8 + j)')} / 4294967296.0::DOUBLE * 2 - 1 AS w FROM range(64) a(i), range(8) b(j))
    SELECT vec_id, j::INT AS pos, {sql_round('greatest(sum(v * w), 0)')} AS value FROM e JOIN w USING (i) GROUP BY vec_id, j""")
def frozen_features(spark, sf_dir):
    """Eight frozen features per vector by a seeded projection."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return per_position(s.extract_features(vectors, "embedding", 64, 8).drop("embedding"), ["vec_id"], "frozen", 6)


SURFACE_EPOCHS = 10


def _surface_sql() -> str:
    names = ["g", "h", "o"]
    sums = ", ".join(f"sum({p} * {q}) AS {p}{q}" for p in names for q in [*names, "y"])
    grad = {n: " + ".join([f"w{m} * {n}{m}" for m in names]) + f" - {n}y" for n in names}
    steps = ", ".join(f"0.9::DOUBLE * v{n} - 0.1::DOUBLE * 2 / oo * ({grad[n]}) AS u{n}" for n in names)
    return f"""
    WITH RECURSIVE st AS (SELECT avg(l_quantity) qm, stddev_pop(l_quantity) qs, avg(l_discount) dm, stddev_pop(l_discount) ds, avg(l_extendedprice) pm, stddev_pop(l_extendedprice) ps FROM lineitem),
    d AS (SELECT (l_quantity - qm) / qs AS g, (l_discount - dm) / ds AS h, 1::DOUBLE AS o, (l_extendedprice - pm) / ps AS y FROM lineitem, st),
    s AS (SELECT {sums} FROM d),
    gd AS (SELECT 0 AS e, {', '.join(f'0::DOUBLE AS w{n}, 0::DOUBLE AS v{n}' for n in names)}
      UNION ALL SELECT e + 1, {', '.join(f'w{n} + u{n} AS w{n}, u{n} AS v{n}' for n in names)} FROM (SELECT gd.*, {steps} FROM gd, s WHERE e < {SURFACE_EPOCHS})),
    w AS (SELECT * FROM gd WHERE e = {SURFACE_EPOCHS}),
    pts AS (SELECT a::INT AS half, id::BIGINT AS id, -a + 2 * a * (id % 50) / 49.0::DOUBLE AS x1, -a + 2 * a * (id // 50) / 49.0::DOUBLE AS x2
          FROM range(2500) r(id), (VALUES (3), (5)) k(a))
    SELECT half, id, {sql_round('x1')} AS x1, {sql_round('x2')} AS x2, {sql_round('wg * x1 + wh * x2 + wo')} AS y_hat, greatest(abs(x1), abs(x2)) > 3 AS extrapolated FROM pts, w"""


@query("surface", _surface_sql())
def surface(spark, sf_dir):
    """A linear model of price on quantity and discount, predicted inside and beyond the training square."""
    cols = ["l_quantity", "l_discount", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem").select(*cols)
    scaled = apply_scaler(items, fit_scaler(items, cols), cols, "_z")
    state, _ = fit_linear_gd(scaled, ["l_quantity_z", "l_discount_z"], "l_extendedprice_z", SURFACE_EPOCHS, steps=1, optimizer=Optimizer("sgd", 0.1, 0.9))
    parts = [s.predict_surface(spark, state.layers, -h, h, 50).withColumn("half", F.lit(int(h))) for h in (3.0, 5.0)]
    both = s.append_predictions(parts)
    return both.select("half", "id", *[rounded(F.col(c)).alias(c) for c in ("x1", "x2", "y_hat")], "extrapolated")


# Fixed values of a 2-3-1 network.
HIDDEN = [[0.5, -0.4, 0.3], [0.2, 0.6, -0.7]]
HIDDEN_BIAS = [0.1, -0.2, 0.05]
OUT = [0.8, -0.5, 0.4]
OUT_BIAS = 0.1
NET_SQL = " + ".join(
    f"{OUT[j]}::DOUBLE * greatest({HIDDEN[0][j]}::DOUBLE * x1 + {HIDDEN[1][j]}::DOUBLE * x2 + {HIDDEN_BIAS[j]}::DOUBLE, 0)" for j in range(3)) + f" + {OUT_BIAS}::DOUBLE"


@query("extrapolation_error", f"""
    WITH p AS (SELECT -5 + 10 * ({sql_u32('7:x1', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x1, -5 + 10 * ({sql_u32('7:x2', 'o_orderkey')} / 4294967296.0::DOUBLE) AS x2 FROM orders)
    SELECT greatest(abs(x1), abs(x2)) > 3 AS extrapolated, {sql_round(f'avg(pow(cos(2 * x1) + cos(3 * x2) - ({NET_SQL}), 2))')} AS mse, count(*)::BIGINT AS n FROM p GROUP BY 1""")
def extrapolation_error(spark, sf_dir):
    """Error of a fixed network at one surface point per order, inside and outside [-3, 3]."""
    points = sample_points(table(spark, sf_dir, "orders"), "o_orderkey", -5.0, 5.0, seed=7)
    layers = [(np.array(HIDDEN), np.array(HIDDEN_BIAS)), (np.array(OUT)[:, None], np.array([OUT_BIAS]))]
    error = s.extrapolation_error(s.predict_points(points, layers, -3.0, 3.0))
    return error.select("extrapolated", rounded(F.col("mse")).alias("mse"), "n")


@query("union_predictions", f"""
    SELECT vec_id, {sql_split('vec_id', 0.2)} AS split, label::INT AS y_true, (list_position(embedding, list_max(embedding)) - 1)::INT % 10 AS y_pred FROM embeddings""")
def union_predictions(spark, sf_dir):
    """Predictions of the two sides, made separately and appended."""
    from tidemill.operators.transform import argmax_class

    data = hash_split(table(spark, sf_dir, "embeddings"), "vec_id", 0.2)
    parts = []
    for side in ("train", "validation"):
        scored = argmax_class(data.where(F.col("split") == side), "embedding")
        parts.append(scored.select("vec_id", "split", F.col("label").cast("int").alias("y_true"), (F.col("y_pred") % 10).alias("y_pred")))
    return s.append_predictions(parts)
