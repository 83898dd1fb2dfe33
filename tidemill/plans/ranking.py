"""Exact global ranks and cuts without sorting everything in one task.

``row_number().over(orderBy(...))`` moves the whole table into one partition.
Here rows fall into order-preserving buckets, buckets are counted (a map-side
combined aggregate), and a rank is the bucket's start plus the position inside
the bucket.  Where only a threshold is needed, just the one bucket that holds
it is sorted and the data itself never moves.

Keys that order rows must identify a row; give several columns if need be.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.functions.arrays import let
from tidemill.functions.hashing import as_list, digest
from tidemill.plans.lookup import null_safe_join, small_join

#: Bounds of value buckets, at least.
SAMPLE = 4095


def bound_count(df: DataFrame) -> int:
    """One less than a power of two: at least four value buckets per shuffle partition."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(SAMPLE, (1 << (wanted - 1).bit_length()) - 1)


def bucket_digits(df: DataFrame) -> int:
    """Hex digits giving at least four buckets per shuffle partition: 16^2 to 16^5 of them."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return next((d for d in range(2, 5) if 16**d >= 4 * partitions), 5)


def _before(*partition, order) -> Window:
    spec = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    return spec.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def hash_row_number(df: DataFrame, key, seed=0, out: str = "rank") -> DataFrame:
    """Dense ranks 1..n in the order of (md5(seed:key), key).

    A bucket is the digest's leading hex digits, so buckets are even for
    unique keys.  One shuffle of the data plus one scan of the key column.
    """
    keys, digits = as_list(key), bucket_digits(df)
    hashed = df.withColumn("_h", digest(seed, *keys)).withColumn("_b", F.substring("_h", 1, digits))
    # At most 16^digits rows (a million) whatever the input, so the running sum
    # may use one task and the result may be broadcast.
    starts = (
        hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(_before(order="_b")), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_b").orderBy("_h", *keys)
    ranked = hashed.withColumn("_r", F.row_number().over(inside)).join(F.broadcast(starts), "_b")
    return ranked.withColumn(out, (F.col("_start") + F.col("_r")).cast("long")).drop("_h", "_b", "_r", "_start")


def dealt_ranks(df: DataFrame, key, parts: int, counted: Column, seed=0, out: str = "rank") -> DataFrame:
    """Ranks 0..n-1 of the ``counted`` rows in digest order, the data dealt over ``parts`` partitions by the same shuffle.

    Rows that are not counted are dealt, too; their rank says nothing.
    """
    keys = as_list(key)
    digits = next((d for d in range(2, 5) if 16**d >= 64 * parts), 5)
    hashed = df.withColumn("_counted", counted).withColumn("_h", digest(seed, *keys)).withColumn("_b", F.substring("_h", 1, digits))
    starts = (  # at most 16^digits rows
        hashed.where("_counted").groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(_before(order="_b")), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_b", "_counted").orderBy("_h", *keys)
    ranked = hashed.repartition(parts, "_b").withColumn("_r", F.row_number().over(inside)).join(F.broadcast(starts), "_b", "left")
    return ranked.withColumn(out, (F.coalesce("_start", F.lit(0)) + F.col("_r") - 1).cast("long")).drop("_h", "_b", "_r", "_start", "_counted")


def hash_cut(df: DataFrame, key, fraction: float, seed=0, out: str = "is_test") -> DataFrame:
    """Flag exactly ceil(n * fraction) rows: the first ones in digest order.

    Counting per bucket, first by 16^3 of them and then inside one, finds the
    bucket that holds the last flagged row, and only that one is sorted.  Rows are then compared with
    the cut inside a projection; the table is not shuffled.
    """
    keys, digits = as_list(key), bucket_digits(df) + 1
    hashed = df.select(digest(seed, *keys).alias("_h"), *keys).withColumn("_b", F.substring("_h", 1, digits))
    every = Window.partitionBy(F.lit(0))
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_c", F.substring("_b", 1, 3))
    coarse = counts.groupBy("_c").agg(F.sum("_n").alias("_n")).select(  # 4,096 rows at most
        "_c", "_n",
        F.coalesce(F.sum("_n").over(_before(order="_c")), F.lit(0)).alias("_start"),
        F.ceil(F.sum("_n").over(every) * F.lit(float(fraction))).alias("_k"),
    )
    inside = (F.col("_start") < F.col("_k")) & (F.col("_k") <= F.col("_start") + F.col("_n"))
    part = coarse.where(inside).select("_c", (F.col("_k") - F.col("_start")).alias("_k"))
    if digits > 3:
        fine = counts.join(F.broadcast(part), "_c").withColumn("_start", F.coalesce(F.sum("_n").over(_before("_c", order="_b")), F.lit(0)))
        holder = fine.where(inside).select("_b", (F.col("_k") - F.col("_start")).alias("_m"))
    else:  # few buckets: each part is one
        holder = part.select(F.col("_c").alias("_b"), F.col("_k").alias("_m"))
    position = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys))
    last = (
        hashed.join(F.broadcast(holder), "_b")  # one row at most
        .withColumn("_r", position).where(F.col("_r") == F.col("_m"))
        .select(F.struct("_h", *keys).alias("_cut"))
    )
    flagged = F.struct(digest(seed, *keys).alias("_h"), *[F.col(k) for k in keys]) <= last.scalar()
    return df.withColumn(out, F.coalesce(flagged, F.lit(False)))


def _bounds(df: DataFrame, col: str, identity: list) -> DataFrame:
    """One row: up to ``bound_count`` sorted values of ``col``.

    The values are those with the smallest digests: a uniform sample that is
    the same on every run, read by a top-k (no sort of the table).  Digests
    over a threshold set by the row count are filtered out before it, so each
    task hands on a few rows however many tasks there are.
    """
    size = bound_count(df)
    hashed = df.select(F.col(col).alias("_v"), digest("bounds", *identity).alias("_h"))
    # Twice the wanted rows are expected below it; as hex digits, so no number is built per row.
    share = df.agg(F.least(F.lit(1.0), F.lit(2.0 * size) / F.greatest(F.count(F.lit(1)), F.lit(1)))).scalar()
    threshold = F.when(share < 1.0, F.lower(F.lpad(F.hex(F.floor(share * F.lit(2.0**48)).cast("long")), 12, "0"))).otherwise("g")
    sample = hashed.where(F.col("_h") < threshold).orderBy("_h").limit(size)
    return sample.agg(F.array_sort(F.collect_list("_v")).alias("_a"))


def value_bucketer(df: DataFrame, col: str, identity: list, bounds: DataFrame | None = None):
    """A function adding ``_b``, a bucket that grows with ``col``; ``identity`` names a unique key of ``df``."""
    bounds = _bounds(df, col, identity) if bounds is None else bounds
    buckets = bound_count(df) + 1
    halves = F.array(*[F.lit(buckets >> i) for i in range(1, buckets.bit_length())])

    def search(sorted_bounds: Column) -> Column:
        """How many bounds are <= the value, by binary search."""
        def step(found: Column, half: Column) -> Column:
            return found + F.when(F.get(sorted_bounds, found + half - 1) <= F.col(col), half).otherwise(0)

        return F.aggregate(halves, F.lit(0), step)

    def add(frame: DataFrame) -> DataFrame:
        # Never NULL, and said so: a join on it then needs no filter that would
        # compute the bucket a second time.
        bucket = F.coalesce(let(F.col("_bounds"), search), F.lit(0))
        return frame.withColumn("_bounds", bounds.scalar()).withColumn("_b", bucket).drop("_bounds")

    return add


def ordered_row_number(df: DataFrame, order: str, out: str = "rank") -> DataFrame:
    """Dense ranks 1..n by a unique column's own value."""
    bucketed = value_bucketer(df, order, [order])(df)
    starts = (
        bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(_before(order="_b")), F.lit(0)).alias("_start"))
    )
    ranked = bucketed.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order)))
    ranked = ranked.join(F.broadcast(starts), "_b")  # a row per bucket, a few per shuffle partition
    return ranked.withColumn(out, (F.col("_start") + F.col("_r")).cast("long")).drop("_b", "_r", "_start")


def group_cut(df: DataFrame, group: str, order: str, keep: Column) -> DataFrame:
    """Per group, the value of ``order`` at the rank given by ``keep``.

    ``keep`` is an expression over ``total``, the group's row count.  Groups
    whose rank is 0 are left out.  Only the bucket holding the wanted rank is
    sorted, so one group may hold most of the rows.
    """
    narrow = df.select(group, order)
    # Two steps need the bounds; they are few, so they are taken once and kept as a local row.
    found = _bounds(narrow, order, [group, order])
    bounds = df.sparkSession.createDataFrame([found.first()], found.schema)
    cells = value_bucketer(narrow, order, [group, order], bounds)(narrow).groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    # At most a cell per bucket and group.
    cells = cells.select(
        group, "_b", "_n",
        F.coalesce(F.sum("_n").over(_before(group, order="_b")), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total"),
    ).withColumn("_k", keep)
    holders = cells.where((F.col("_start") < F.col("_k")) & (F.col("_k") <= F.col("_start") + F.col("_n")))
    # The bucket as a range of values: finding its rows takes two comparisons.
    holders = holders.withColumn("_bounds", bounds.scalar()).select(
        group, (F.col("_k") - F.col("_start")).alias("_m"),
        F.when(F.col("_b") > 0, F.get("_bounds", F.col("_b") - 1)).alias("_from"), F.get("_bounds", F.col("_b")).alias("_to"))
    inside = (F.col("_from").isNull() | (F.col(order) >= F.col("_from"))) & (F.col("_to").isNull() | (F.col(order) < F.col("_to")))
    position = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return (
        small_join(narrow, holders, group, "inner").where(inside)
        .withColumn("_r", position).where(F.col("_r") == F.col("_m"))
        .select(group, F.col(order).alias("cut"))
    )


def first_cut(df: DataFrame, order: str, n: int) -> DataFrame:
    """One row: the value of a unique column at rank ``n``; no row if there are fewer."""
    one = df.select(F.lit(0).alias("_all"), order)
    return group_cut(one, "_all", order, F.lit(n)).select("cut")


def competition_rank(df: DataFrame, by: str, value: str, out: str = "rank", descending: bool = True) -> DataFrame:
    """``rank()`` of ``value`` inside each ``by`` group, equal values sharing a rank.

    Equal values are counted first, so neither a hot group nor a hot value
    lands in one task.
    """
    values = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    bucketed = value_bucketer(values, value, [by, value])(values)
    order = F.desc if descending else F.asc
    starts = (
        bucketed.groupBy(by, "_b").agg(F.sum("_n").alias("_n"))
        .select(by, "_b", F.coalesce(F.sum("_n").over(_before(by, order=order("_b"))), F.lit(0)).alias("_start"))
    )
    inside = F.coalesce(F.sum("_n").over(_before(by, "_b", order=order(value))), F.lit(0))
    ranks = (
        null_safe_join(bucketed.withColumn("_r", inside), starts, [by, "_b"])
        .select(by, value, (F.col("_start") + F.col("_r") + 1).cast("long").alias(out))
    )
    return null_safe_join(df, ranks, [by, value])
