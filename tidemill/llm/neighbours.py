"""Approximate nearest neighbours by a permutation index."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import kept

#: Pivots: a sample of rows, the lowest hashes.  They order every vector.
PIVOTS = 128
#: Share of a block's vectors, nearest by footrule, whose true distance is taken, and their least number.
SHARE, LEAST = 0.15, 500
#: Vectors and queries that one task holds at a time.
BLOCK, QUERIES = 8192, 2048


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an identifier and a vector of finite components, not all zero, of the commonest length (of equally common ones the longest)."""
    v = F.col(vector).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & fine)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def pivots(rows: DataFrame, n: int, count: int) -> np.ndarray:
    """`count` rows (all, if fewer) of the lowest hashes of their identifiers."""
    h = F.xxhash64("vec_id", F.lit("pivot"))
    chance = min(1.0, 4.0 * count / max(n, 1) + 64.0 / max(n, 1))
    few = rows.where(h / F.lit(2.0**64) + 0.5 <= chance).orderBy(h, "vec_id").limit(count)
    return np.array([r["v"] for r in few.select("v").collect()], dtype=np.float64)


def ranks(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(vectors, pivots): the place of each pivot in the vector's order from nearest to farthest; equal distances in pivot order."""
    d = (p * p).sum(axis=1)[None] - 2 * x @ p.T
    out = np.empty(d.shape, dtype=np.int16)
    np.put_along_axis(out, d.argsort(axis=1, kind="stable"), np.arange(p.shape[0], dtype=np.int16)[None], axis=1)
    return out


def search(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", n_pivots: int = PIVOTS, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query vector its k nearest found, by Euclidean distance, ties to the smaller vec_id.

    The vectors are dealt by hash to blocks of about BLOCK rows.  A block is
    an inverted file: for each pivot the places at which its vectors have that
    pivot.  A query's footrule distance to all vectors of the block is summed
    pivot by pivot, the best `share` of the block (LEAST at least) is compared
    by true distance, and the block's k best go on.  Queries come in groups of
    QUERIES, so a task holds one block and one group, whatever the tables'
    sizes; between tasks only k rows per query and block move.

    Rows whose identifier equals the query's are not its candidates.  Rows
    without identifier, and vectors that are null, zero, of another length
    than most, or hold null or non-finite components take no part.  An
    identifier in several rows counts once per query, with its nearest
    vector; a query in several rows uses the smallest vector.  No rows give no
    rows; other columns are ignored, whatever their names.
    """
    rows = kept(usable(df, key, vector), "vectors")
    asked = usable(queries, key, vector).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    asked = kept(asked, "queries")
    n, m = rows.count(), asked.count()
    p = pivots(rows, n, n_pivots)
    blocks, groups = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(m / QUERIES))
    id_type = dict(rows.dtypes)["vec_id"]
    data = rows.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    ask = asked.withColumn("g", F.pmod(F.xxhash64("query_id", F.lit("group")), F.lit(groups)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, x = left["vec_id"].to_numpy(), _matrix(left["v"])
        asked_ids, q = right["query_id"].to_numpy(), _matrix(right["q"])
        out = [[], [], []]
        if len(ids) and len(asked_ids):
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            posts = np.ascontiguousarray(ranks(x, p).T)
            size = min(len(ids), max(least, math.ceil(share * len(ids))))
            for who, vec, places in zip(asked_ids, q, ranks(q, p), strict=True):
                far = np.zeros(len(ids), dtype=np.int32)
                for post, place in zip(posts, places, strict=True):
                    far += np.abs(post - place)
                best = np.argpartition(far, size - 1)[:size]
                best = np.sort(best[ids[best] != who])
                dist = np.sqrt(((x[best] - vec) ** 2).sum(axis=1))
                top = np.argsort(dist, kind="stable")
                _, first = np.unique(ids[best][top], return_index=True)
                top = top[np.sort(first)][:k]
                out[0].append(np.full(len(top), who))
                out[1].append(ids[best][top])
                out[2].append(dist[top])
        cols = [np.concatenate(c) if c else [] for c in out]
        return pa.table({"query_id": pa.array(cols[0], left["vec_id"].type), "vec_id": pa.array(cols[1], left["vec_id"].type), "score": pa.array(cols[2], pa.float64())})

    found = data.groupBy("b", "g").cogroup(ask.groupBy("b", "g")).applyInArrow(near, f"query_id {id_type}, vec_id {id_type}, score double")
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    if not len(flat):
        return np.zeros((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
