from pyspark.sql import functions as F

from tidemill.operators import transform as t
from tidemill.operators.split import hash_split
from tidemill.queries.registry import per_position, query, rounded, sql_round, sql_split, table

ITEM = ["l_orderkey", "l_linenumber"]


@query("select_xy", "SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount AS x2, l_extendedprice AS y FROM lineitem")
def select_xy(spark, sf_dir):
    xy = t.select_xy(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", ITEM)
    return xy.select(*ITEM, F.col("x")[0].alias("x1"), F.col("x")[1].alias("x2"), "y")


@query("log_target", f"SELECT o_orderkey, {sql_round('ln(o_totalprice)')} AS log_y FROM orders WHERE o_totalprice > 0")
def log_target(spark, sf_dir):
    logged = t.log_target(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")
    return logged.select("o_orderkey", rounded(F.col("log_y")).alias("log_y"))


@query("center", f"""
    SELECT l_orderkey, l_linenumber, {sql_round('l_quantity - avg(l_quantity) OVER ()')} AS overall,
           {sql_round('l_quantity - avg(l_quantity) OVER (PARTITION BY l_returnflag)')} AS by_flag FROM lineitem""")
def center(spark, sf_dir):
    """Centred by the table's mean and by the mean of each return flag."""
    items = table(spark, sf_dir, "lineitem").select(*ITEM, "l_returnflag", "l_quantity")
    both = t.center(t.center(items, "l_quantity", suffix="_c"), "l_quantity", by="l_returnflag", suffix="_g")
    return both.select(*ITEM, rounded(F.col("l_quantity_c")).alias("overall"), rounded(F.col("l_quantity_g")).alias("by_flag"))


@query("rescale", f"""
    SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS pos, {sql_round('unnest(embedding)::DOUBLE / 255', 8)} AS value FROM embeddings""")
def rescale(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return per_position(t.rescale(vectors, "embedding"), ["vec_id"], "embedding", 8)


@query("standardize", f"""
    WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, {sql_split('l_orderkey', 0.2)} AS split FROM lineitem),
    s AS (SELECT avg(l_quantity) qm, stddev_pop(l_quantity) qs, avg(l_extendedprice) pm, stddev_pop(l_extendedprice) ps FROM d WHERE split = 'train')
    SELECT l_orderkey, l_linenumber, split, {sql_round('(l_quantity - qm) / qs')} AS quantity, {sql_round('(l_extendedprice - pm) / ps')} AS price FROM d, s""")
def standardize(spark, sf_dir):
    """Statistics of the training side applied to both sides."""
    items = hash_split(table(spark, sf_dir, "lineitem").select(*ITEM, "l_quantity", "l_extendedprice"), "l_orderkey", 0.2)
    cols = ["l_quantity", "l_extendedprice"]
    scaled = t.apply_scaler(items, t.fit_scaler(items.where(F.col("split") == "train"), cols), cols)
    return scaled.select(*ITEM, "split", rounded(F.col("l_quantity_std")).alias("quantity"), rounded(F.col("l_extendedprice_std")).alias("price"))


@query("standardize_array", f"""
    WITH d AS (SELECT vec_id, {sql_split('vec_id', 0.2)} AS split, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
    s AS (SELECT pos, avg(v) m, stddev_pop(v) sd FROM d WHERE split = 'train' GROUP BY pos)
    SELECT vec_id, pos::INT AS pos, {sql_round('(v - m) / sd')} AS value FROM d JOIN s USING (pos)""")
def standardize_array(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = hash_split(vectors, "vec_id", 0.2)
    stats = t.fit_array_scaler(vectors.where(F.col("split") == "train"), "embedding")
    return per_position(t.apply_array_scaler(vectors, stats, "embedding"), ["vec_id"], "embedding", 6)


@query("reshape_flatten", """
    WITH d AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT vec_id, (pos // 8)::INT AS row_no, (pos % 8)::INT AS col_no, pos::INT AS pos, v AS value FROM d""")
def reshape_flatten(spark, sf_dir):
    """64 values as 8 x 8 rows; flattening gives the original positions back."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    flat = t.flatten_rows(t.reshape(vectors, 8, 8, out="rows"), "rows", "flat")
    cells = flat.select("vec_id", "flat", F.posexplode("rows").alias("row_no", "r")).select("vec_id", "flat", "row_no", F.posexplode("r").alias("col_no", "v"))
    position = F.col("row_no") * 8 + F.col("col_no")
    same = F.element_at("flat", position + 1) == F.col("v")
    return cells.where(same).select("vec_id", "row_no", "col_no", position.alias("pos"), F.col("v").cast("double").alias("value"))


@query("argmax_class", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS y_pred FROM embeddings")
def argmax_class(spark, sf_dir):
    return t.argmax_class(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "y_pred")


@query("channel_means", f"""
    WITH d AS (SELECT generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT (pos % 4)::INT AS channel, {sql_round('avg(v)')} AS mean FROM d GROUP BY 1""")
def channel_means(spark, sf_dir):
    means = t.channel_means(table(spark, sf_dir, "embeddings"), 4, "embedding")
    return means.select("channel", rounded(F.col("mean")).alias("mean"))


@query("normalize_channels", f"""
    WITH d AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings),
    m AS (SELECT pos % 4 AS channel, avg(v) AS mean FROM d GROUP BY 1)
    SELECT vec_id, pos::INT AS pos, {sql_round('v - mean')} AS value, {sql_round('v / 127.5::DOUBLE - 1')} AS unit_range FROM d JOIN m ON channel = pos % 4""")
def normalize_channels(spark, sf_dir):
    """Both preprocessing modes on vectors read as 4 x 4 x 4 images."""
    images = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("pixels"))
    shifted = t.normalize_channels(images, "subtract_mean", 4, t.channel_means(images, 4), out="shifted")
    both = t.normalize_channels(shifted, "unit_range", 4, out="unit").select("vec_id", F.posexplode(F.arrays_zip("shifted", "unit")).alias("pos", "z"))
    return both.select("vec_id", "pos", rounded(F.col("z.shifted")).alias("value"), rounded(F.col("z.unit")).alias("unit_range"))


@query("resize_nearest", """
    SELECT vec_id, p::INT AS pos, embedding[(p // 4) * 2 * 8 + (p % 4) * 2 + 1]::DOUBLE AS value FROM embeddings, range(16) r(p)""")
def resize_nearest(spark, sf_dir):
    """8 x 8 to 4 x 4."""
    images = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    return per_position(t.resize_images(images, 8, 8, 1, 4, 4), ["vec_id"], "pixels")
