"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shingles import slices

#: Bound of the training sample: documents per language (lowest hashes), segments of one document, words of a segment.
DOCS, SEGMENTS, WORDS = 400, 4, 20
#: Hashed features, and letters of a word; a longer stretch of letters is several words in a row.
BUCKETS, LETTERS = 1 << 17, 30
EPOCHS, STEP, PENALTY = 30, 0.3, 1e-5
#: Words of one chain when labelling; a longer text is a sequence of chains.
CHAIN = 128
REMEMBERED = 150_000
WORD = re.compile(rf"[^\W\d_]{{1,{LETTERS}}}")


@dataclass
class Model:
    labels: list[str]
    start: np.ndarray  # label scores at the beginning of a chain
    change: np.ndarray  # scores of one label after another
    weight: np.ndarray  # label scores of the features


def features(words: list[str]) -> np.ndarray:
    """(words, features) bucket numbers: the word itself, affixes up to 4 letters, inner 2- and 3-grams with word edges; -1 where there is none."""
    grid = np.array([f"\x02{w}\x03" for w in words], dtype=f"U{LETTERS + 2}")
    code = grid.view(np.uint32).reshape(len(words), LETTERS + 2).astype(np.uint64)
    size = (code > 0).sum(axis=1)
    at = np.arange(LETTERS + 2)

    def bucket(h, kind):
        h = (h + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32)

    prime = np.uint64(1_000_003)
    rolling = np.zeros((len(words), LETTERS + 3), dtype=np.uint64)
    for i in range(LETTERS + 2):
        rolling[:, i + 1] = np.where(code[:, i] > 0, rolling[:, i] * prime + code[:, i], rolling[:, i])
    out = [bucket(rolling[:, -1], 1)[:, None]]
    for k in (2, 3):
        grams = np.zeros((len(words), LETTERS + 3 - k), dtype=np.uint64)
        for j in range(k):
            grams = grams * prime + code[:, j : j + LETTERS + 3 - k]
        out.append(np.where(at[: LETTERS + 3 - k] + k <= size[:, None], bucket(grams, 10 + k), -1))
    for k in (1, 2, 3, 4):
        last = np.zeros(len(words), dtype=np.uint64)
        for j in range(k):
            last = last * prime + code[np.arange(len(words)), np.maximum(size - 1 - k + j, 0)]
        whole = size - 2 >= k
        out.append(np.where(whole, bucket(rolling[:, k + 1], 20 + k), -1)[:, None])
        out.append(np.where(whole, bucket(last, 30 + k), -1)[:, None])
    return np.concatenate(out, axis=1)


def emissions(model: Model, words: list[str], piece: int = 20_000) -> np.ndarray:
    """(words, labels) scores."""
    rows = [model.weight[np.where(f < 0, BUCKETS, f)].sum(axis=1) for f in (features(words[i : i + piece]) for i in range(0, len(words), piece))]
    return np.concatenate(rows) if rows else np.zeros((0, len(model.labels)))


def posteriors(score: np.ndarray, size: np.ndarray, start: np.ndarray, change: np.ndarray, changes: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward over padded chains (chains, steps, labels): label posteriors; expected changes of label are added to `changes`."""
    steps = score.shape[1]
    e = np.exp(score - score.max(axis=2, keepdims=True))
    a, live = np.exp(change - change.max()), np.arange(steps) < size[:, None]
    alpha, beta = np.empty_like(e), np.ones_like(e)
    now = np.exp(start - start.max()) * e[:, 0]
    alpha[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        now = np.where(live[:, t, None], (alpha[:, t - 1] @ a) * e[:, t], alpha[:, t - 1])
        alpha[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        before = (beta[:, t + 1] * e[:, t + 1]) @ a.T
        beta[:, t] = np.where(live[:, t + 1, None], before / before.sum(axis=1, keepdims=True), beta[:, t + 1])
        if changes is not None:
            pair = alpha[:, t, :, None] * a[None] * (e[:, t + 1] * beta[:, t + 1])[:, None, :]
            changes += (pair / pair.sum(axis=(1, 2), keepdims=True))[live[:, t + 1]].sum(axis=0)
    post = alpha * beta
    return post / post.sum(axis=2, keepdims=True)


def sample(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(lang, words): segments of words from at most DOCS documents of each language, chosen by hash from all of them."""
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key).cast("string"), F.lit("sample")).alias("h"), F.col(text).alias("text"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # as many rows as labels of the model
    if not counts:
        return known.select("lang", F.array(F.lit("")).alias("words")).limit(0)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * DOCS / n + 50.0 / n))])[F.col("lang")]
    few = known.where((F.col("h") / F.lit(2.0**64) + 0.5) < share)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", F.md5("text")))).where(F.col("rank") <= DOCS)

    def run(batches):
        for batch in batches:
            lang, out = [], []
            for row, (h, body) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                words = WORD.findall(body.lower())
                parts = [words[i : i + WORDS] for i in range(0, len(words), WORDS)]
                picked = np.random.default_rng(h & 0xFFFFFFFF).permutation(len(parts))[:SEGMENTS]
                out += [parts[i] for i in sorted(picked)]
                lang += [batch.column(0)[row].as_py()] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"])

    return few.select("lang", "h", "text").mapInArrow(run, "lang string, words array<string>")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", epochs: int = EPOCHS) -> Model:
    """Trains on the bounded sample: weights of the features and transitions between labels, by the likelihood's gradient.

    A document's words carry its language as label.  So that changes of
    language are seen, every other training chain joins beginnings of two
    segments, often of different languages.
    """
    rows = sorted((r["lang"], r["words"]) for r in sample(docs, key, text, lang).collect() if r["words"])
    labels = sorted({a for a, _ in rows})
    if not rows:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros((BUCKETS + 1, 0), dtype=np.float32))
    rng = np.random.default_rng(7)
    number = {w: i for i, w in enumerate(sorted({w for _, ws in rows for w in ws}))}
    single = [([number[w] for w in ws], [labels.index(a)] * len(ws)) for a, ws in rows]
    mixed = []
    for i, j in zip(rng.permutation(len(single)), rng.permutation(len(single)), strict=True):
        (w, y), (v, z) = single[i], single[j]
        m, n = rng.integers(1, len(w) + 1), rng.integers(1, len(v) + 1)
        mixed.append((w[:m] + v[:n], y[:m] + z[:n]))
    chains = single[::2] + mixed[::2]
    steps, k = max(len(w) for w, _ in chains), len(labels)
    size = np.array([len(w) for w, _ in chains])
    x, y = np.zeros((len(chains), steps), dtype=np.int32), np.zeros((len(chains), steps), dtype=np.int32)
    for i, (w, z) in enumerate(chains):
        x[i, : len(w)], y[i, : len(w)] = w, z
    live = np.arange(steps) < size[:, None]
    f = features(list(number))
    f = np.where(f < 0, BUCKETS, f)
    weight, start, change = np.zeros((BUCKETS + 1, k)), np.zeros(k), np.zeros((k, k))
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
    squares = [np.full(p.shape, 1e-8) for p in (weight, start, change)]
    for _ in range(epochs):
        emit = weight[f].sum(axis=1)
        pair = np.zeros((k, k))
        post = posteriors(emit[x], size, start, change, pair)
        error = post.copy()
        np.put_along_axis(error, y[:, :, None], np.take_along_axis(error, y[:, :, None], 2) - 1, 2)
        error[~live] = 0
        by_word = np.stack([np.bincount(x[live], error[:, :, c][live], minlength=len(number)) for c in range(k)], axis=1)
        flat = f.ravel()
        grad = np.stack([np.bincount(flat, np.repeat(by_word[:, c], f.shape[1]), minlength=BUCKETS + 1) for c in range(k)], axis=1)
        grad[BUCKETS] = 0
        n = live.sum()
        grads = (grad / n + PENALTY * weight, error[:, 0].sum(axis=0) / n, (pair - seen) / n + PENALTY * change)
        for p, g, s in zip((weight, start, change), grads, squares, strict=True):
            s += g * g
            p -= STEP * g / np.sqrt(s)
    return Model(labels, start, change, weight.astype(np.float32))


class Labeller:
    """Labels the words of texts; scores of words are remembered up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.score = np.zeros((REMEMBERED, len(model.labels)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = set(words) - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, set(words)
            if len(new) > len(self.score):
                self.score = np.zeros((len(new), self.score.shape[1]))
        new = sorted(new)
        at = len(self.known)
        self.score[at : at + len(new)] = emissions(self.model, new)
        self.known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def words(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray]:
        """The words of each text, and the label posteriors of all words in a row."""
        split = [WORD.findall(t.lower()) for t in texts]
        count = np.array([len(s) for s in split], dtype=np.int64)
        total = int(count.sum())
        if not total or not self.model.labels:
            return split, np.zeros((total, len(self.model.labels)))
        score = self.score[self._numbers([w for s in split for w in s])]
        per = -(-count // CHAIN)
        first = np.concatenate([np.arange(p) * CHAIN for p in per.tolist()]) + np.repeat(np.cumsum(count) - count, per)
        stop = np.minimum(first + CHAIN, np.repeat(np.cumsum(count), per))
        out = np.empty((total, len(self.model.labels)))
        for at in range(0, len(first), 2048):
            a, b = first[at : at + 2048], stop[at : at + 2048]
            place = a[:, None] + np.arange(int((b - a).max()))
            live = place < b[:, None]
            post = posteriors(score[np.minimum(place, total - 1)], b - a, self.model.start, self.model.change)
            out[place[live]] = post[live]
        return split, out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with lang_pred, score and n_words behind their columns (columns of these names are replaced).

    lang_pred is the label with the largest expected share of the words and
    score that share; without a letter, or without labels to learn, it is
    `und` with score 0.  Null text has no letter.  Every word of a text
    counts; long texts are labelled in chains.  Rows are independent, so
    repeated rows and null identifiers need no rule.
    """
    added = ["lang_pred", "score", "n_words"]
    sort = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64())])

    # Only the text enters Python, and no text comes back.
    @F.arrow_udf("struct<lang_pred:string,score:double,n_words:long>")
    def judge(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model)
        for part in parts:
            yield pa.StructArray.from_arrays(_labelled(part, labeller), fields=list(sort))

    found = docs.drop(*added).withColumn("_found", judge(F.col(text).cast("string")))
    return found.select("*", *[F.col(f"_found.{c}") for c in added]).drop("_found")


def _labelled(texts: pa.Array, labeller: Labeller) -> list[pa.Array]:
    lang, score, n = [], [], []
    for rows in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
        split, post = labeller.words([t or "" for t in rows.column(0).to_pylist()])
        at = 0
        for words in split:
            share = post[at : at + len(words)].sum(axis=0) / max(1, len(words))
            at += len(words)
            best = int(share.argmax()) if len(share) else 0
            known = len(share) and any(c.isalpha() for w in words for c in w)
            lang.append(labeller.model.labels[best] if known else "und")
            score.append(min(1.0, float(share[best])) if known else 0.0)
            n.append(len(words))
    return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64())]


def runs(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Code-switched text as runs: doc_id, run, lang, first_word, n_words; consecutive words whose likeliest label is the same."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        labeller = Labeller(model)
        for batch in batches:
            out = []
            for rows in slices(batch):
                split, post = labeller.words([t or "" for t in rows.column(1).to_pylist()])
                best, at = post.argmax(axis=1) if len(model.labels) else np.zeros(0, int), 0
                for i, words in enumerate(split):
                    own = best[at : at + len(words)]
                    at += len(words)
                    edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
                    ends = np.r_[edges[1:], len(own)]
                    out += [(rows.column(0)[i].as_py(), r, model.labels[own[a]], int(a), int(b - a)) for r, (a, b) in enumerate(zip(edges, ends, strict=False))]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "run", "lang", "first_word", "n_words"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, run long, lang string, first_word long, n_words long")


def held_out(key: str = "doc_id"):
    """Documents never trained on."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
