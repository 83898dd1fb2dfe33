from pyspark.sql import functions as F

from tidemill.functions.optimizers import Optimizer
from tidemill.operators import lifecycle
from tidemill.queries.registry import query, rounded, sql_round, table
from tidemill.queries.train import RULES, logit_sql

FRACTION = 0.33
EPOCHS = 3
ORDER_NUMBERS = ["o_totalprice", "o_custkey", "age"]
FEATURES_SQL = f"""
    d00 AS (SELECT o_totalprice, o_custkey::DOUBLE AS o_custkey, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::DOUBLE AS age, (o_orderstatus = 'F')::INT::DOUBLE AS y,
            row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) <= ceil(count(*) OVER () * {FRACTION}::DOUBLE) AS val FROM orders),
    st AS (SELECT {', '.join(f'avg({c}) AS m{i}, stddev_pop({c}) AS s{i}' for i, c in enumerate(ORDER_NUMBERS))} FROM d00 WHERE NOT val),
    d AS MATERIALIZED (SELECT val, y, {', '.join(f'({c} - m{i}) / s{i} AS x{i}' for i, c in enumerate(ORDER_NUMBERS))} FROM d00, st)"""
CLIPPED = "least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)"


def order_outcome(spark, sf_dir):
    """Order status from price, customer number and age: 67% train, 33% test, three Adam epochs."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"),
        F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double").alias("age"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return lifecycle.classify_table(orders, "o_orderkey", ORDER_NUMBERS, "label", EPOCHS, RULES["adam"], FRACTION)


SCORED_SQL = f"""
    WITH {FEATURES_SQL}, {logit_sql('adam', EPOCHS, len(ORDER_NUMBERS))},
    q AS (SELECT val, y, 1 / (1 + exp(-({' + '.join(f'w{i} * x{i}' for i in range(len(ORDER_NUMBERS)))} + w{len(ORDER_NUMBERS)}))) AS p FROM d, adam_w{EPOCHS})"""


@query("table_lifecycle", f"""{SCORED_SQL}
    SELECT CASE WHEN val THEN 'test' ELSE 'train' END AS split, {sql_round(f'avg(-(y * ln({CLIPPED}) + (1 - y) * ln(1 - {CLIPPED})))')} AS loss,
           {sql_round('avg(((p > 0.5)::INT = y)::INT)')} AS accuracy, count(*)::BIGINT AS n FROM q GROUP BY val""")
def table_lifecycle(spark, sf_dir):
    """Loss and accuracy of both sides after the whole tabular job."""
    scores = order_outcome(spark, sf_dir).scores
    return scores.select("split", rounded(F.col("loss")).alias("loss"), rounded(F.col("accuracy")).alias("accuracy"), "n")


@query("table_confusion", f"""{SCORED_SQL},
    c AS (SELECT y::INT AS y_true, (p > 0.5)::INT AS y_pred, count(*) AS n FROM q WHERE val GROUP BY 1, 2)
    SELECT a::INT AS y_true, b::INT AS y_pred, coalesce(n, 0)::BIGINT AS n FROM range(2) s(a) CROSS JOIN range(2) t(b) LEFT JOIN c ON y_true = a AND y_pred = b""")
def table_confusion(spark, sf_dir):
    """Confusion grid of the test side of the same job."""
    return order_outcome(spark, sf_dir).confusion


@query("array_lifecycle")
def array_lifecycle(spark, sf_dir):
    """Network with one hidden layer and dropout on the vectors; scores per side."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return lifecycle.classify_arrays(vectors, "vec_id", "embedding", "label", 10, [128], 4, divisor=0.25, optimizer=Optimizer("adam", 0.01)).scores
