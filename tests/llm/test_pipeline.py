"""The pipeline against the stages' brute-force versions, and the contract with the entry file."""

import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from test_llm_operators import brute_groups
from tidemill.llm import bpe, mixing
from tidemill.llm.common import kept, table


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), []
    odd = spark.createDataFrame([(900001, None, None, None, None), (900002, "...", "en", "src0", 3), (900003, "", "de", None, 0)], docs.schema)
    docs = docs.union(odd)
    for name, stage in pipeline.STAGES:
        before, docs = docs, kept(stage(spark, docs, sf_dir), name)
        out.append((name, before, docs))
    return out


def test_stages_keep_the_columns_of_documents(stages, spark, sf_dir):
    columns = table(spark, sf_dir, "documents").columns
    assert [n for n, _, _ in stages] == ["language", "line_dedup", "near_dedup", "mix", "encode"]
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_language_drops_only_texts_without_letters(stages):
    _, before, after = stages[0]
    gone = before.select("doc_id").subtract(after.select("doc_id"))
    assert {r[0] for r in gone.collect()} == {900001, 900002, 900003}


def test_near_copies_leave_one_of_each_group(stages):
    _, before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute_groups(rows)})


def test_near_copies_are_told_by_five_words_and_four_fifths(stages, spark, sf_dir):
    words = [f"w{i}" for i in range(50)]
    near = [*words[:25], "other", *words[26:]]  # 41 of 51 shingles of five words are shared, 43 of 51 of four
    far = [*words[:25], "other", *words[26:38], "last", *words[39:]]
    _, before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute_groups(rows, 5, 80)})
    own = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    left = pipeline.near_dedup(spark, spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in own], before.schema), sf_dir)
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in brute_groups(own, 5, 80)})
    assert len({c for _, _, c in brute_groups(own, 5, 80)}) < len({c for _, _, c in brute_groups(own)})


def test_a_large_group_of_edited_copies_leaves_one_whole_document(stages, spark, sf_dir):
    rng, schema = random.Random(6), stages[0][1].schema
    article = [[f"a{rng.randrange(10**6)}" for _ in range(10)] for _ in range(40)]
    texts = {}
    for i in range(40):
        mine = [list(x) for x in article]
        for _ in range(2 * (i > 0)):
            mine[rng.randrange(40)][rng.randrange(10)] = f"e{i}"
        texts[i] = "\n".join(["menu", *(" ".join(x) for x in mine)])
    texts |= {i: "\n".join(["menu", *(" ".join(f"b{rng.randrange(10**6)}" for _ in range(10)) for _ in range(5))]) for i in range(40, 60)}
    out = pipeline.line_dedup(spark, spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], schema), sf_dir)
    out = pipeline.near_dedup(spark, kept(out, "whole"), sf_dir)
    assert {r.doc_id: r.text for r in out.collect()} == {i: texts[i].removeprefix("menu\n") for i in (0, *range(40, 60))}


def test_copies_follow_the_draws(stages):
    _, before, after = stages[3]
    want = Counter(r.doc_id for r in mixing.mix(before).collect())
    assert Counter(r.doc_id for r in after.collect()) == want
    assert after.select("doc_id", "text").subtract(before.select("doc_id", "text")).count() == 0


def test_last_stage_encodes_every_copy(stages):
    _, before, after = stages[4]
    assert after.count() == before.count()
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    assert after.select("doc_id", "decoded_sha256").exceptAll(before.select("doc_id", digest)).count() == 0
    assert bpe.encode_table(before).agg(F.sum(F.size("ids"))).first() == after.agg(F.sum("n_tokens")).first()


def test_run_gives_what_the_stages_give(spark, sf_dir):
    rows = pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0


def test_ten_queries_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_entry_imports_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; assert len(e.queries()) > 70 and 'pipeline' not in e.queries()"
    root = contract.__file__.rsplit("/", 1)[0]
    # a missing module raises ModuleNotFoundError with its name, as a deleted one does
    code = code.replace("sys.modules['corpus_pipeline'] = None", "import importlib.abc\nclass No(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, path, target=None):\n        if name == 'corpus_pipeline' or name.startswith('tidemill.llm'):\n            raise ModuleNotFoundError(name, name=name)\nsys.meta_path.insert(0, No())")
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0
