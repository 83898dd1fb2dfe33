"""URL filters, tokenizer alignment and periodic runs against brute force, on rows the tables lack too."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tidemill.llm import align, periods, queries, urls
from tidemill.llm.common import table
from test_llm_operators import ODD, docs

# 11: URL filters


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda r: (r[0].count("."), len(r[1]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("com", "", "block"), ("b.com", "/x", "allow"), ("b.com", "/x/y", "block"), ("b.com", "/x/y/", "allow"),
    ("b.com", "/x/y/", "block"), ("a.b.com", "/", "allow"), ("", "", "block"), ("org", "/fr/", "allow"), ("org", "/f", "block"), ("straße.de", "/ü", "block"),
]
URLS = [
    None, "", "no scheme", "http://", "://", "http:///path", "http://NET", "http://net/", "https://Example.NET/en/x?y#z", "http://example.net/en", "http://notexample.net/en/",
    "http://b.com", "http://b.com/x", "http://b.com/xy", "http://b.com/x/y", "http://b.com/x/yz", "http://b.com/x/y/z", "http://A.b.com/x/y/", "http://c.a.b.com", "http://a.b.com?x=/x",
    "http://b.com//x", "a://b://c.com/d", "http://x.org/fr/1", "http://x.org/f", "http://x.org/F", "http://com", "http://.com/", "http://com./", "http://straße.de/üb", "http://b.com/x\ny/",
    "http://net:80/", "http://user@b.com/x/y/", "http://b.com#/x", "http://" + "a." * 300 + "b.com/" + "x/" * 300, "http://net/" + "é" * 20000,
]


@pytest.mark.parametrize("limit", [1000, 1])
def test_urls_match_brute_force_sent_and_joined(spark, limit):
    rows = [(i, u, "x", 1, "r") for i, u in enumerate(URLS)] + [(None, "http://net/", None, None, None), (8, URLS[8], None, None, None), (8, URLS[8], None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path int, rule string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("ok", None, "block")], urls.RULE)
    out = urls.judge(pages, rules, limit=limit)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    assert got == sorted(((r[0], *brute_url(r[1], RULES)) for r in rows), key=str)
    assert urls.judge(pages.limit(0), rules, limit=limit).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0), default="block", limit=limit).collect()} == {"block"}


def test_many_random_rules_give_the_same_both_ways(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randrange(1, 4)))
    path = lambda: "".join(rng.choice(["/", "x", "y", "/x", "/y/"]) for _ in range(rng.randrange(4)))
    rules = [(host(), path() and "/" + path(), rng.choice(["allow", "block"])) for _ in range(150)]
    found = [f"http://{host()}{p if p.startswith('/') or not p else '/' + p}" for p in (path() for _ in range(400))]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    want = sorted((i, *brute_url(u, rules)) for i, u in enumerate(found))
    for limit in (1000, 1):
        out = urls.judge(pages, spark.createDataFrame(rules, urls.RULE), limit=limit).select("page_id", "host", "path", "rule", "verdict")
        assert sorted(map(tuple, out.collect())) == want


def test_url_trie_moves_no_row(spark, sf_dir):
    plan = queries.QUERIES["op11_url_trie"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "html" not in plan


# 12: alignment


A = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = align.byte_of_letter()


def brute_tokens(text):
    if not text:
        return [], []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    spelt_a = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    spelt_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
        return [], []
    return list(zip(a, np.cumsum(list(map(len, spelt_a))).tolist())), list(zip(b, np.cumsum(list(map(len, spelt_b))).tolist()))


def brute_alignment(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    rows, counts = [], Counter()
    for text in texts:
        a, b = brute_tokens(text)
        both = sorted({e for _, e in a} & {e for _, e in b})
        groups, links, start = [], [], 0
        for end in both:
            groups.append(",".join(str(i) for i, e in a if start < e <= end) + "|" + ",".join(str(i) for i, e in b if start < e <= end))
            start = end
        i = j = 0
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            ea, eb = a[i][1], b[j][1]
            i, j = i + (ea <= eb), j + (eb <= ea)
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    return [(na, nb, ng, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), g) for na, nb, ng, ls, g in rows]


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "a\nb\tc", "Hello, world!", "naïve café 🙂🙂 日本語", "ﬁ ①", "x▁y", "<s> <unk> <|endoftext|> <0x41>", "\x00\x01", "e\u0301",
    "internationalization of tokenizers", "1234567890 " * 30, "word " * 400, "don't we'll I'd", "\u200b\ufeff", "the the the the", "the the the the",
]


def test_alignment_matches_brute_force(spark, sf_dir, monkeypatch):
    texts = TEXTS + [r.text for r in table(spark, sf_dir, "documents").limit(60).collect()]
    want = brute_alignment(texts)
    for frequent in (align.FREQUENT, 5):
        monkeypatch.setattr(align, "FREQUENT", frequent)
        rows = docs(spark, list(enumerate(texts))).repartition(3)
        got = align.align(rows).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == want
        digests = {r.doc_id: r.groups_sha256 for r in align.align(rows, digest=True).collect()}
        assert digests == {i: hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for i, w in enumerate(want)}
    assert sum(w[3] > 0 for w in want) > 60 and sum(w[3] == 0 for w in want) >= 3


def test_alignment_of_odd_rows_and_an_empty_table(spark):
    got = align.align(docs(spark, ODD)).collect()
    want = brute_alignment([t for _, t in ODD])
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _), w in zip(ODD, want)), key=str)
    assert align.align(docs(spark, [])).count() == 0


def test_runs_of_a_long_text_give_the_tokens_of_the_whole(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "ü", "x y", "a b c ", "7 ", " ▁", "é e", "\u00a0", "🙂 a"]) for _ in range(5000)).encode()
    whole = align.aligner().align([text])
    monkeypatch.setattr(align, "RUN", 40)
    assert len(align.aligner().runs(text)) > 20
    cut = align.aligner().align([text])
    assert all(np.array_equal(x, y) for x, y in zip(whole[:4], cut[:4])) and whole[4].equals(cut[4]) and np.array_equal(whole[5][0], cut[5][0])


def test_ranks_give_the_ids_of_the_byte_level_file_for_every_character():
    a = align.aligner().a
    assert a._quick is not None
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 40000):
        texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}  {chr(c)}!\n{chr(c)}" for c in points[i : i + 40000 : 7 if i else 1]]
        quick = [x.tolist() for x in a.encode(texts)]
        assert quick == [e.ids for e in A.encode_batch_fast(texts, add_special_tokens=False)]


def test_pointer_jumping_finds_the_last_token_of_long_groups():
    ends_a, ends_b = np.arange(2, 20002, 2), np.r_[np.arange(3, 20000, 2), 20000]
    group_a, group_b, n = align.labelled(ends_a, ends_b)
    assert n == 1 and not group_a.any() and not group_b.any()
    group_a, group_b, n = align.labelled(np.array([1, 4, 5, 9]), np.array([2, 3, 5, 7, 8, 9]))
    assert (group_a.tolist(), group_b.tolist(), n) == ([0, 0, 0, 1], [0, 0, 0, 1, 1, 1], 2)


# 13: periodic runs


def brute_runs(words, least=24, periods_=3):
    found = {}
    for q in range(1, len(words) // periods_ + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods_ * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic_words(rng, n):
    """Random words with runs of all kinds of periods put in, some beside or inside each other."""
    out = []
    while len(out) < n:
        kind = rng.randrange(4)
        if kind == 0:
            out += [rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randrange(1, 40))]
        elif kind == 1:
            unit = [rng.choice("ab") for _ in range(rng.randrange(1, 50))]
            out += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        elif kind == 2:
            unit = [str(rng.randrange(50)) for _ in range(rng.randrange(1, 70))]
            out += (unit * 6)[: rng.randrange(20, 300)]
        else:
            unit = (["a"] * rng.randrange(1, 30) + ["b"]) * rng.randrange(1, 3)
            out += unit * rng.randrange(1, 6)
    return out[:n]


def test_runs_match_brute_force_appended_at_once_and_word_by_word():
    for seed in range(40):
        rng = random.Random(seed)
        words = periodic_words(rng, rng.randrange(1, 700))
        _, found, _ = periods.find_runs([" ".join(words).encode()])
        assert found[0] == brute_runs(words), seed
        numbers, catcher = periods.Numbers(), periods.Catcher()
        ids = periods.word_numbers(" ".join(words).encode(), numbers)
        at, seen = 0, set()
        while at < len(ids):
            step = 1 if seed % 2 else rng.randrange(1, 60)
            for s, e, p in catcher.append(ids[at : at + step]):
                assert brute_runs(words[: at + step]).count((s, e - s, p)) == 1
                seen.add((s, e - s, p))
            at += step
        assert sorted((s, e - s, p) for (s, e), p in catcher.runs.items()) == brute_runs(words), seed
        assert set(brute_runs(words)) <= seen


def test_runs_do_not_reach_into_the_next_text():
    rng = random.Random(11)
    texts = [periodic_words(rng, rng.randrange(0, 300)) for _ in range(60)] + [["a"] * 20, ["a"] * 20, ["a"] * 24, ["a", "b"] * 12, ["a", "b"] * 11 + ["a"]]
    _, found, collapsed = periods.find_runs([" ".join(t).encode() for t in texts])
    for words, runs, rest in zip(texts, found, collapsed):
        assert runs == brute_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert rest == " ".join(w for i, w in enumerate(words) if i not in gone).encode()


def test_words_of_regular_structure():
    morse = ["a"]
    while len(morse) < 3000:
        morse += ["b" if w == "a" else "a" for w in morse]
    fib = [["a"], ["a", "b"]]
    while len(fib[-1]) < 2000:
        fib.append(fib[-1] + fib[-2])
    for words in (morse[:3000], fib[-1][:1500], ["a"] * 2500, ["a", "b", "a"] * 700):
        assert periods.find_runs([" ".join(words).encode()])[1][0] == brute_runs(words)


def brute_row(key, text):
    w = [x.decode() for x in (text or "").encode().split()]
    if key is not None:
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    rest = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (key, len(runs), *best, None if not runs else 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def test_run_query_matches_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.QUERIES["op13_dyadic_runs"](spark, sf_dir).collect()))
    assert got == sorted(brute_row(r.doc_id, r.text) for r in rows)
    assert sum(r[1] for r in got) > 5


def test_run_digests_of_odd_rows_and_an_empty_table(spark):
    rows = [*ODD, (9, "a\u00a0b " * 40), (10, "x\x0by\x0cz " * 30), *[(i, " ".join(f"w{j}" for j in range(200))) for i in range(100, 160)]]
    frame = docs(spark, rows)
    found = periods.digests(periods.periodic_runs(frame.withColumn("text", periods.planted(F.col("doc_id"), F.col("text")))))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((brute_row(i, t) for i, t in rows), key=str)
    assert periods.periodic_runs(docs(spark, [])).count() == 0


def test_a_text_split_in_pieces_has_the_same_words(monkeypatch):
    text = ("x\x0by  z\n" * 50 + "longword" * 30 + " \t" + "ü " * 40).encode()
    whole = periods.find_runs([text])
    monkeypatch.setattr(periods, "CHUNK", 16)
    cut = periods.find_runs([text])
    assert whole[0].tolist() == cut[0].tolist() and whole[1:] == cut[1:]


def test_short_blocks_are_refused():
    with pytest.raises(ValueError):
        periods.Catcher(words=10)
