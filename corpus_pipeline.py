"""The corpus pipeline: each stage reads what the one before wrote.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  run() writes every stage's rows as Parquet
to the shared scratch folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, jaccard, langid, lines, mixing
from tidemill.llm.common import arrow_rows, kept, narrow, table

#: Below this share of words in its likeliest language a text is in none of them (four languages: chance is 0.25).
LEAST_SHARE = 0.3
#: Near copies: words of a shingle, and the percentage of shingles that linked documents share.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Documents sent to a Python worker at a time: its memory stays with it from stage to stage.
BATCH_ROWS = 1000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language the model knows, go."""
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text.

    A group of near copies counts as one page for a line, or all lines that
    its members share would go as boilerplate, from every one of them.
    """
    groups = jaccard.near_groups(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).where("n_shingles > 0")
    ids = groups.groupBy(F.col("doc_id").alias("_id")).agg(F.min("component_id").alias("_page"), F.max("component_id").alias("_last")).where("_page = _last")
    copies = kept(ids.where("_page <> _id").select("_id", "_page"), "near-pages")
    named = docs.join(narrow(copies), F.col("doc_id") == F.col("_id"), "left")
    heads = copies.select(F.col("_page").alias("_head")).distinct()
    named = named.join(narrow(kept(heads, "near-heads")), F.col("doc_id") == F.col("_head"), "left")
    out = lines.drop_boilerplate(named.withColumn("_page", F.coalesce("_page", "_head")), page="_page")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return jaccard.one_per_group(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says, in a global random order."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded bytes."""
    return bpe.round_trip(docs)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with arrow_rows(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = kept(stage(spark, docs, sf_dir), name)
    return docs
