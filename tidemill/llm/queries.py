"""One query per operator over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import align, bpe, chat, exact, html, jaccard, langid, lines, mixing, neighbours, periods, tokenfiles, urls
from tidemill.llm.common import kept, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op2_ngram_jaccard_join", jaccard.ORACLE)
def _jaccard(spark, sf_dir) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op5_poisson_mixing", mixing.ORACLE)
def _mixing(spark, sf_dir) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "text", F.round("rate", 9).alias("rate"), "copy", "shuffle_key")


@query("op6_quotation_linking")
def _chat(spark, sf_dir) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256 FROM t
"""


@query("op7_stateful_exact_dedup", EXACT_SQL)
def _exact(spark, sf_dir) -> DataFrame:
    docs = exact.located(spark, f"{sf_dir}/documents.parquet")
    return exact.dedup(docs, locator="locator")


@query("op9_site_line_dedup", lines.ORACLE)
def _lines(spark, sf_dir) -> DataFrame:
    out = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


@query("op4_prefix_bpe_round_trip")
def _bpe(spark, sf_dir) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op1_crf_language_id")
def _language(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "n_words")


@query("op10_separator_scan")
def _tokens(spark, sf_dir) -> DataFrame:
    files = kept(tokenfiles.flat_files(table(spark, sf_dir, "documents")), "token-files")
    return tokenfiles.document_tokens(files)


@query("op3_wrapper_extraction")
def _html(spark, sf_dir) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op8_permutation_index")
def _neighbours(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query("op11_url_trie", urls.ORACLE)
def _urls(spark, sf_dir) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, urls.RULE)
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op12_pointer_alignment")
def _align(spark, sf_dir) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), digest=True)


@query("op13_dyadic_runs")
def _periods(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periods.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periods.digests(periods.periodic_runs(docs))
