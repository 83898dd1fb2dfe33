
from pyspark.sql import functions as F

from tidemill.operators import augment as a
from tidemill.operators.split import hash_split
from tidemill.operators.transform import flatten_rows, reshape
from tidemill.queries.registry import per_position, query, rounded, sql_round, sql_split, table

FLAT = "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings"
NUMBERS = ["angle", "shift_y", "shift_x", "shear", "zoom_y", "zoom_x"]


def _uniform(name: str, part: int) -> str:
    return f"(('0x' || substr({name}, {8 * part + 1}, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _around(name: str, part: int, span: float, base: float = 0.0) -> str:
    return f"{base}::DOUBLE + CASE WHEN split = 'train' THEN ({_uniform(name, part)} * 2 - 1) * {span}::DOUBLE ELSE 0 END"


PLAN_SQL = f"""
    s AS (SELECT vec_id, embedding, {sql_split('vec_id', 0.2)} AS split FROM embeddings),
    f AS (SELECT vec_id, embedding, split, variant, md5('42:geometry:' || vec_id || ':' || variant) AS h1, md5('42:zoom:' || vec_id || ':' || variant) AS h2
          FROM s, range(3) v(variant) WHERE split = 'train' OR variant = 0),
    plan AS (SELECT vec_id, embedding, split, variant, {_around('h1', 0, 20.0)} AS angle, {_around('h1', 1, 0.1)} AS shift_y, {_around('h1', 2, 0.1)} AS shift_x,
             {_around('h1', 3, 0.1)} AS shear, {_around('h2', 0, 0.2, 1.0)} AS zoom_y, {_around('h2', 1, 0.2, 1.0)} AS zoom_x,
             split = 'train' AND {_uniform('h2', 2)} < 0.5 AS flip_h, split = 'train' AND {_uniform('h2', 3)} < 0.5 AS flip_v FROM f)"""


def _plan(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    return a.augment_plan(hash_split(vectors, "vec_id", 0.2), "vec_id", 3, split="split")


@query("augment_plan", f"""
    WITH {PLAN_SQL}
    SELECT vec_id, split, variant::INT AS variant, {', '.join(f'{sql_round(c)} AS {c}' for c in NUMBERS)}, flip_h, flip_v FROM plan""")
def augment_plan(spark, sf_dir):
    """Three variants per training vector, the others unchanged."""
    plan = _plan(spark, sf_dir)
    return plan.select("vec_id", "split", "variant", *[rounded(F.col(c)).alias(c) for c in NUMBERS], "flip_h", "flip_v")


def _rows(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    return reshape(vectors, 8, 8)


@query("flip_h", f"SELECT vec_id, ((pos // 8) * 8 + 7 - pos % 8)::INT AS pos, v AS value FROM ({FLAT})")
def flip_h(spark, sf_dir):
    return per_position(flatten_rows(a.flip(_rows(spark, sf_dir), "horizontal")), ["vec_id"], "pixels")


@query("flip_v", f"SELECT vec_id, ((7 - pos // 8) * 8 + pos % 8)::INT AS pos, v AS value FROM ({FLAT})")
def flip_v(spark, sf_dir):
    return per_position(flatten_rows(a.flip(_rows(spark, sf_dir), "vertical")), ["vec_id"], "pixels")


@query("shift_edge", """
    SELECT vec_id, p::INT AS pos, embedding[least(greatest(p // 8 + 2, 0), 7) * 8 + least(greatest(p % 8 - 1, 0), 7) + 1]::DOUBLE AS value
    FROM embeddings, range(64) r(p)""")
def shift_edge(spark, sf_dir):
    """One pixel to the right, two up."""
    return per_position(flatten_rows(a.shift(_rows(spark, sf_dir), 1, -2, 8, 8)), ["vec_id"], "pixels")




@query("affine_nearest", f"""
    WITH {PLAN_SQL},
    o AS (SELECT *, CASE WHEN flip_v THEN 7 - p // 8 ELSE p // 8 END - 3.5::DOUBLE AS r, CASE WHEN flip_h THEN 7 - p % 8 ELSE p % 8 END - 3.5::DOUBLE AS c
          FROM plan, range(64) q(p)),
    m AS (SELECT *, r * zoom_y - sin(radians(shear)) * c * zoom_x + shift_y * 8 AS y, cos(radians(shear)) * c * zoom_x + shift_x * 8 AS x FROM o),
    t AS (SELECT *, floor(cos(radians(angle)) * y - sin(radians(angle)) * x + 3.5 + 0.5)::BIGINT AS iy,
                 floor(sin(radians(angle)) * y + cos(radians(angle)) * x + 3.5 + 0.5)::BIGINT AS ix FROM m)
    SELECT vec_id, variant::INT AS variant, p::INT AS pos, embedding[least(greatest(iy, 0), 7) * 8 + least(greatest(ix, 0), 7) + 1]::DOUBLE AS value FROM t""")
def affine_nearest(spark, sf_dir):
    """The drawn rotation, shift, shear, zoom and flips applied to 8 x 8 images."""
    warped = a.affine(_plan(spark, sf_dir), 8, 8, 1)
    return per_position(warped, ["vec_id", "variant"], "pixels")


@query("map_images", f"SELECT vec_id, pos::INT AS pos, {sql_round('(v * v)::FLOAT::DOUBLE')} AS value FROM ({FLAT})")
def map_images(spark, sf_dir):
    """A user function (squaring) on whole batches of images."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("pixels"))
    return per_position(a.map_images(vectors, lambda x: x.astype("float64") ** 2), ["vec_id"], "pixels", 6)
