"""Line deduplication by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import kept

#: A line on more than this share of a host's pages is boilerplate, if on so many pages at least.
RATIO, LEAST_PAGES = 0.01, 5
#: Hosts (one row each) up to which the lines to drop are sent to every executor, and their bytes.
HOSTS, BYTES = 100_000, 64 << 20


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, page: str | None = None) -> DataFrame:
    """(host, line_md5, pages, host_pages) of the lines over the ratio.

    A page counts once for a line however often it holds it, and pages with
    the very same text count as one page: copies are the business of exact
    deduplication.  So do pages with the same value in the column `page`, if
    one is named: near copies of one text; where it is null the text tells.
    Counts are combined before they are shuffled.
    """
    same = F.col(page).cast("string") if page else F.lit(None).cast("string")
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("body"), same.alias("same")).where("body is not null")
    pages = pages.withColumn("page", F.unhex(F.md5(F.coalesce(F.concat(F.lit("page "), F.md5("same")), "body")))) if page else pages.withColumn("page", F.unhex(F.md5("body")))
    total = pages.groupBy("host").agg(F.count_distinct("page").alias("host_pages"))
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.split("body", "\n"))).alias("line")).where("line <> ''")
    counts = lines.groupBy("host", F.md5("line").alias("line_md5")).agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= least_pages)
    return counts.join(total, "host").where(F.col("pages") > ratio * F.col("host_pages"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, page: str | None = None) -> DataFrame:
    """The documents with boilerplate lines taken out of `text`, plus n_lines and n_dropped (int).

    Lines end at \\n and are compared exactly; empty lines are never dropped.
    A null host is the host ''.  Null text stays null with 0 lines; a text that
    is all boilerplate becomes empty.  Repeated rows are treated alike, the
    other columns stay as they are, an empty table stays empty.  Pages with
    one value in the column `page` count once for a line.

    A host has at most (lines per page / ratio) lines over the ratio, so they
    fit one array per host.  That table is broadcast when measured small, and
    joined by host otherwise (adaptive execution splits a hot host).
    """
    bad = boilerplate(docs, host, text, ratio, least_pages, page).groupBy(F.col("host").alias("_host")).agg(F.collect_set("line_md5").alias("_bad"))
    bad = kept(bad, "boilerplate")
    hosts, lines = bad.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_bad")), F.lit(0))).first()
    if hosts <= HOSTS and lines * 40 + hosts * 100 <= BYTES:
        bad = F.broadcast(bad)
    joined = docs.withColumn("_host", F.coalesce(F.col(host).cast("string"), F.lit(""))).join(bad, "_host", "left")
    rows = F.split(F.col(text), "\n")
    joined = joined.withColumn("_rows", F.when(F.col("_bad").isNotNull(), F.filter(rows, lambda x: (x == "") | ~F.array_contains("_bad", F.md5(x)))).otherwise(rows))
    n = F.coalesce(F.size(rows), F.lit(0))
    out = joined.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(n)).withColumn("n_dropped", F.when(F.col(text).isNull(), 0).otherwise(n - F.size("_rows")))
    return out.withColumn(text, F.when(F.col("n_dropped") > 0, F.array_join("_rows", "\n")).otherwise(F.col(text))).drop("_host", "_bad", "_rows")


ORACLE = f"""
WITH pages AS (SELECT doc_id, coalesce(source, '') AS host, text, md5(text) AS page FROM documents),
totals AS (SELECT host, count(DISTINCT page) AS host_pages FROM pages WHERE text IS NOT NULL GROUP BY host),
lines AS (SELECT host, page, unnest(string_split(text, chr(10))) AS line FROM pages),
bad AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT page) AS pages FROM lines WHERE line <> '' GROUP BY host, line) JOIN totals USING (host)
        WHERE pages >= {LEAST_PAGES} AND pages > {RATIO} * host_pages),
per_host AS (SELECT host, list(line) AS gone FROM bad GROUP BY host)
SELECT doc_id, source,
       CASE WHEN gone IS NULL OR text IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: x = '' OR NOT list_contains(gone, x)), chr(10)) END AS text,
       coalesce(len(string_split(text, chr(10))), 0)::INTEGER AS n_lines,
       CASE WHEN gone IS NULL OR text IS NULL THEN 0 ELSE len(list_filter(string_split(text, chr(10)), lambda x: x <> '' AND list_contains(gone, x))) END::INTEGER AS n_dropped
FROM documents LEFT JOIN per_host ON host = coalesce(source, '')
"""
