"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import kept

#: Without target weights a source weighs its size to this power.
TEMPERATURE = 0.5
#: A rate above this is the sum of equal parts, each drawn with its own seed: e^-rate stays far from underflow.
PART = 32.0
STEPS = 160  # the chance of more than this at rate PART is below 2^-60
SOURCES = 100_000
_PMF_STEPS = [math.lgamma(k + 1) for k in range(STEPS)]


def uniform(*parts):
    """In [0, 1) with 52 bits, from the md5 of the parts joined by ':'."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", text: str = "text", total: float = 1.0) -> DataFrame:
    """(source, size, rate): mean repetitions that bring a source to its weight of `total` times the corpus' characters.

    Sizes are characters of all rows, an empty text counting as one.  Sources
    absent from given weights get weight 0; the null source is named ''.
    """
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    sizes = docs.groupBy(name.alias("_source")).agg(F.sum(F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1))).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(TEMPERATURE))
    else:
        table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        weight = F.coalesce(table[F.col("_source")].cast("double") if weights else F.lit(0.0), F.lit(0.0))
    sized = kept(sizes.withColumn("weight", weight), "source-sizes")
    all_size, all_weight = sized.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(all_weight) * F.lit(all_size) / F.col("size") * F.lit(float(total)) if all_weight else F.lit(0.0)
    return sized.select("_source", "size", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, key: str = "doc_id", source: str = "source", text: str = "text", total: float = 1.0, seed: int = 0) -> DataFrame:
    """Every document as often as its Poisson draw says, in a global random order, plus rate, copy (from 1) and shuffle_key.

    The draw inverts the Poisson distribution at a uniform made from md5 of
    (seed, identifier, part), so a rerun or a lost executor gives the same
    copies.  Rows with one identifier (or a null one) draw alike.  Rate 0 gives
    no copy.  Null texts are carried along, the other columns stay as they are,
    an empty table stays empty.

    The order is that of shuffle_key = md5(seed, identifier, copy): rows are
    dealt to partitions by it and sorted by it within each, one shuffle of the
    copies; a hot source is spread like any other.
    """
    per = kept(rates(docs, weights, source, text, total), "rates")
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    share = F.col("rate") / parts
    logs = F.array(*[F.lit(x) for x in _PMF_STEPS])
    pmf = F.transform(logs, lambda g, k: F.when(F.col("_share") > 0, F.exp(k * F.log("_share") - F.col("_share") - g)).otherwise(F.when(k == 0, 1.0).otherwise(0.0)))
    # running sums of the pmf, made once per source
    cdf = F.aggregate("_pmf", F.array().cast("array<double>"), lambda acc, p: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + p)))
    per = per.withColumn("_parts", parts).withColumn("_share", share).withColumn("_pmf", pmf)
    per = per.select("_source", "rate", "_parts", cdf.alias("_cdf"))
    per = kept(per, "distributions")
    if per.count() <= SOURCES // 10:
        per = F.broadcast(per)
    named = docs.withColumn("_source", F.coalesce(F.col(source).cast("string"), F.lit(""))).join(per, "_source")
    ident = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    draw = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")),
        F.lit(0),
        lambda n, part: n + _below(F.col("_cdf"), uniform(F.lit(str(seed)), ident, part.cast("string"))),
    )
    copies = named.withColumn("_n", draw).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), ident, F.col("copy").cast("string"))))
    return copies.drop("_source", "_parts", "_cdf", "_n").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _below(cdf, u):
    """How many entries of the distribution lie at or below u: the draw."""
    return F.size(F.filter(cdf, lambda c: c <= u))


ORACLE = f"""
WITH sizes AS (SELECT coalesce(source, '') AS s, sum(greatest(coalesce(length(text), 0), 1))::DOUBLE AS size FROM documents GROUP BY 1),
rates AS (SELECT s, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
cdf AS (SELECT s, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS c FROM rates, range({STEPS}) t(k)),
drawn AS (SELECT d.doc_id, any_value(rate) AS rate, count(*) FILTER (WHERE c <= ('0x' || substr(md5('0:' || d.doc_id || ':1'), 1, 13))::BIGINT / 4503599627370496.0) AS n
          FROM documents d JOIN cdf ON s = coalesce(d.source, '') GROUP BY d.doc_id)
SELECT d.doc_id, d.source, d.text, round(rate, 9) AS rate, copy::INTEGER AS copy, md5('0-order:' || d.doc_id || ':' || copy) AS shuffle_key
FROM documents d JOIN (SELECT doc_id, rate, unnest(range(1, n + 1)) AS copy FROM drawn) USING (doc_id)
"""
