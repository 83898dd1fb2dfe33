"""Exact Jaccard join on shingle sets with set-relation skipping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import shingles
from tidemill.llm.common import components, kept, narrow

WORDS, PERCENT = 4, 85


def _sets(docs: DataFrame, key: str, text: str, words: int, keep) -> DataFrame:
    """(doc_id, n, d1, d2, tokens): set size, 128-bit name of the set, and the `keep(n)` smallest tokens."""

    def run(batches):
        for rows in (part for batch in batches for part in shingles.slices(batch)):
            sets = list(shingles.row_sets(rows.column(1), words))
            names = [shingles.set_name(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), shingles.lists([s[: keep(len(s))] for s in sets])],
                names=["doc_id", "n", "d1", "d2", "tokens"],
            )

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n long, d1 long, d2 long, tokens array<long>")


def _prefix(n, percent: int):
    """Tokens of which one at least is shared with any set similar enough."""
    return n - (percent * n + 99) // 100 + 1


def _prefix_col(n, percent: int):
    return n - F.floor((n * percent + 99) / 100) + 1


def _overlap(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """Adds inter, na, nb: the exact intersection of each pair of sets."""
    left = sets.select(F.col("d1").alias(a), F.col("tokens").alias("_ta"), F.col("n").alias("na"))
    right = sets.select(F.col("d1").alias(b), F.col("tokens").alias("_tb"), F.col("n").alias("nb"))
    both = pairs.join(left, a).join(right, b)
    return both.withColumn("inter", F.size(F.array_intersect("_ta", "_tb"))).drop("_ta", "_tb")


def _similar(percent: int):
    return 100 * F.col("inter") >= percent * (F.col("na") + F.col("nb") - F.col("inter"))


def suspects(rows: DataFrame, percent: int) -> DataFrame:
    """Classes of equal sets (d1, d2, n, first_id, class_size) that may have a partner.

    A set with as many tokens that no other class has as its prefix is long
    cannot: ordered with those first, its whole prefix is unshared.  Counts
    are combined before the shuffle, so a token of a third of all rows is one
    row per task.
    """
    owners = rows.select(F.explode("tokens").alias("token"), "d1").groupBy("token").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi"))
    own = owners.where("lo = hi").groupBy(F.col("lo").alias("d1")).agg(F.count(F.lit(1)).alias("own"))
    classes = rows.groupBy("d1", "d2").agg(F.max("n").alias("n"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("class_size"))
    return classes.join(own, "d1", "left").withColumn("suspect", (F.col("n") > 0) & (F.coalesce("own", F.lit(0)) < _prefix_col(F.col("n"), percent)))


def index_lists(sets: DataFrame, percent: int) -> DataFrame:
    """The inverted lists: (token, d1, n, pos) for the prefix tokens, rarest first, of lists with two members at least.

    Positions count the unshared tokens, which come first in every set.
    """
    tokens = sets.select("d1", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    met = tokens.join(shared, "token")
    by_set = Window.partitionBy("d1", "n")
    rank = F.row_number().over(by_set.orderBy("freq", "token"))
    met = met.withColumn("rank", rank).withColumn("met", F.count(F.lit(1)).over(by_set))
    entries = met.withColumn("pos", F.col("n") - F.col("met") + F.col("rank") - 1).where(F.col("pos") < _prefix_col(F.col("n"), percent))
    return kept(entries.select("token", "d1", "n", "pos"), "lists")


def star_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each set against the head of its lists that it meets most often: (d1, pivot, inter, na) of the similar ones.

    The head of a list is the set that has the token earliest, so the one with
    least of its own: of a group of edited copies the least edited.
    """
    heads = entries.groupBy("token").agg(F.min(F.struct("pos", "d1")).alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1")
    first = heads.select("token", F.col("head.d1").alias("pivot"))
    votes = entries.join(first, "token").where("d1 <> pivot").groupBy("d1", "pivot").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("d1").agg(F.max(F.struct("votes", "pivot")).alias("b")).select("d1", F.col("b.pivot").alias("pivot"))
    return kept(_overlap(kept(best, "star"), sets, "d1", "pivot").where(_similar(percent)), "star-links")


def cross_links(entries: DataFrame, sets: DataFrame, stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All similar pairs (a, b) of different components, without visiting pairs inside one.

    A list's entries form blocks by (component, pivot).  A pair of blocks is
    skipped when sizes or positions rule out every pair of members.  The
    remaining pivots are intersected once; what a member can have in common
    with another follows from that answer: at most the pivots' intersection
    plus what each has beyond its pivot.  Only pairs within that bound are
    intersected themselves.
    """
    own = stars.select("d1", "pivot", (F.col("na") - F.col("inter")).alias("beyond"))
    at = entries.join(labels, F.col("d1") == F.col("id"), "left").drop("id").join(own, "d1", "left")
    at = at.select("token", "d1", "n", "pos", F.coalesce("component", "d1").alias("comp"), F.coalesce("pivot", "d1").alias("pivot"), F.coalesce("beyond", F.lit(0)).alias("beyond"))
    mixed = at.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    at = kept(at.join(mixed, "token", "left_semi"), "mixed")
    need = lambda x, y: F.ceil((x + y) * percent / (100 + percent))
    blocks = at.groupBy("token", "comp", "pivot").agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.max(F.col("n") - F.col("pos")).alias("left"), F.max("beyond").alias("beyond"))
    x, y = blocks.alias("x"), blocks.alias("y")
    fits = (F.col("x.comp") < F.col("y.comp")) & (100 * F.col("x.n_hi") >= percent * F.col("y.n_lo")) & (100 * F.col("y.n_hi") >= percent * F.col("x.n_lo"))
    fits = fits & (F.least("x.left", "y.left") >= need(F.col("x.n_lo"), F.col("y.n_lo")))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & fits)
    bounds = [F.col(f"{side}.{c}").alias(f"{c}_{name}") for side, name in (("x", "a"), ("y", "b")) for c in ("n_lo", "n_hi", "left", "beyond")]
    pairs = kept(pairs.select(F.col("x.token").alias("token"), F.col("x.pivot").alias("pa"), F.col("y.pivot").alias("pb"), *bounds), "block-pairs")
    answers = _overlap(pairs.select("pa", "pb").distinct(), sets, "pa", "pb").select("pa", "pb", "inter")
    live = pairs.join(answers, ["pa", "pb"]).where(F.col("inter") + F.col("beyond_a") + F.col("beyond_b") >= need(F.col("n_lo_a"), F.col("n_lo_b")))
    a = at.select(F.col("token").alias("ta"), F.col("pivot").alias("qa"), F.col("d1").alias("a"), F.col("n").alias("na"), F.col("pos").alias("ia"), F.col("beyond").alias("ba"))
    b = at.select(F.col("token").alias("tb"), F.col("pivot").alias("qb"), F.col("d1").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("ib"), F.col("beyond").alias("bb"))
    # a member goes on only if the best that the other block may hold could be its partner
    least = need(F.col("na"), F.col("n_lo_b"))
    hopeful = (F.col("token") == F.col("ta")) & (F.col("pa") == F.col("qa")) & (100 * F.col("na") >= percent * F.col("n_lo_b")) & (100 * F.col("n_hi_b") >= percent * F.col("na"))
    hopeful = hopeful & (F.least(F.col("na") - F.col("ia"), F.col("left_b")) >= least) & (F.col("inter") + F.col("ba") + F.col("beyond_b") >= least)
    wanted = need(F.col("na"), F.col("nb"))
    possible = (F.col("token") == F.col("tb")) & (F.col("pb") == F.col("qb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    possible = possible & (F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= wanted) & (F.col("inter") + F.col("ba") + F.col("bb") >= wanted)
    members = live.join(a, hopeful).join(b, possible).select("a", "b").distinct()
    return kept(_overlap(kept(members, "members"), sets, "a", "b").where(_similar(percent)).select("a", "b"), "cross-links")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, class_size.

    Words are runs of other than ASCII white space, A-Z lower-cased; a set is
    the distinct shingles of `words` words, or a shorter text's whole word
    sequence.  Two documents link when 100 |x and y| >= percent |x or y|.
    component_id is the smallest doc_id reachable by links; class_id is the
    smallest doc_id with the same set and class_size their number.  Copies are
    one class and never become pairs.

    Shingles are 64-bit hashes, sets are named by 128 bits.  Null or blank text
    is an empty set, linked with nothing (its component_id is its doc_id).
    Rows repeated with one doc_id are rows of their own; null doc_ids take part
    and are passed over when the smallest is sought (null if there is no
    other).  Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    rows = kept(_sets(docs, key, text, words, lambda n: min(n, _prefix(n, percent) * 3 // 2 + 16) if n else 0), "sets")
    classes = kept(suspects(rows, percent), "classes")
    asked = classes.where("suspect").select("first_id", "d1", "d2")
    wanted = narrow(kept(asked.select(F.col("first_id").alias("_id")).distinct(), "asked"))
    source = docs.join(wanted, F.col(key).eqNullSafe(F.col("_id")), "left_semi")
    full = _sets(source, key, text, words, lambda n: n).select("d1", "d2", "n", "tokens").join(asked.select("d1", "d2"), ["d1", "d2"], "left_semi")
    sets = kept(full.select("d1", "n", "tokens"), "suspect-sets")
    entries = index_lists(sets, percent)
    stars = star_links(entries, sets, percent)
    links = stars.select(F.col("d1").alias("a"), F.col("pivot").alias("b"))
    labels = components(links, "stars")
    more = cross_links(entries, sets, stars, labels, percent)
    if more.limit(1).count():
        labels = components(links.union(more), "groups")

    named = classes.join(labels, F.col("d1") == F.col("id"), "left").select("d1", "d2", "n", "first_id", "class_size", F.when(F.col("suspect"), F.col("component")).alias("component"))
    named = kept(named, "named")
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id"))
    # Classes without partner, nearly all, take no part in the join: their missing component would be one key.
    grouped = named.where("component IS NOT NULL").join(least, "component").select("d1", "d2", F.col("least_id").alias("component_id"), F.col("first_id").alias("class_id"), "class_size")
    single = named.where("component IS NULL").select("d1", "d2", F.col("first_id").alias("component_id"), F.col("first_id").alias("class_id"), "class_size")
    named = grouped.unionAll(single)
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2").join(named, ["d1", "d2"])
    empty = F.col("n_shingles") == 0
    return out.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(empty, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those whose group has a smaller doc_id; rows repeated with the kept doc_id and rows without doc_id stay."""
    groups = near_groups(docs, key, text, words, percent)
    gone = kept(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near-copies")
    return docs.join(narrow(gone), F.col(key) == F.col("_gone"), "left_anti")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (WITH RECURSIVE r(id, to_id) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.id, e.b FROM r JOIN both_ways e ON e.a = r.to_id) SELECT id, min(to_id) AS c FROM r GROUP BY id)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.id = doc_id
"""
