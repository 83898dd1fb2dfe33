"""Alignment of two tokenizers by pointer jumping over overlapping tokens."""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import kept, narrow
from tidemill.llm.shingles import slices

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text tokenized at a time, about; a longer text is cut where neither tokenizer joins.
RUN = 1 << 20
#: A space between two ASCII letters: both vocabularies start a token at it.
CUT = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Counts sent to every executor, at most: pairs holding at least this share of all links can't be more.
FREQUENT = 200_000


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onward, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE file.

    If its merges are in the order of their ids and its pattern is the usual
    one, ranks say the same as merges, and the quicker rank encoder takes them;
    otherwise the file's own library does.
    """

    def __init__(self, path: str):
        letters = byte_of_letter()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in letters for c in token)}
        self.bytes = table({i: t for t, i in vocab.items()})
        self._slow = tokenizers.Tokenizer.from_file(path)
        self._slow.encode_special_tokens = True
        split = {k: v for k, v in spec["pre_tokenizer"].items() if k != "trim_offsets"}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab.get(bytes(letters[c] for c in a + b)) for a, b in merges]
        ranked = spec["normalizer"] is None and split == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        ranked = ranked and len(vocab) == len(spec["model"]["vocab"]) and made == sorted(made) and made == list(range(256, 256 + len(made)))
        self._quick = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab, special_tokens={}) if ranked else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._quick:
            try:
                return [self._quick.encode_to_numpy(t, disallowed_special=()) for t in texts]
            except BaseException as e:  # the rank encoder's own panics are no Exceptions
                if type(e).__name__ != "PanicException":
                    raise
        return [np.array(e.ids, dtype=np.uint32) for e in self._slow.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which adds a space before a text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.bytes = table({i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.vocab_size())})
        # Whether every piece that holds a space begins with it, so that pieces never reach over a word's end.
        self.by_word = not any("▁" in m.id_to_piece(i).lstrip("▁") for i in range(m.vocab_size()))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.uint32) for ids in self.model.encode(texts, num_threads=1)]


def table(tokens: dict[int, bytes]) -> pa.Array:
    """Bytes by id; an id without any is null."""
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.binary())


_LOADED: dict[tuple[str, str], "Aligner"] = {}


def aligner(a: str | None = None, b: str | None = None) -> "Aligner":
    """The worker's aligner for two vocabulary files, which every machine has at these paths."""
    key = (a or public_tokenizers.path(BYTE_LEVEL), b or public_tokenizers.path(PIECES))
    if key not in _LOADED:
        _LOADED[key] = Aligner(ByteLevel(key[0]), Pieces(key[1]))
    return _LOADED[key]


def labelled(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every A and B token, numbered in order, from the byte ends of two tilings of the same bytes.

    A token overlaps a stretch of the other side's tokens; it points to the
    farthest right of them if that one ends behind it, to the B token of the
    two if both end together, and a B token that ends with an A token to
    itself.  Doubling the successors until nothing changes leads every token
    to the last one of its group, in rounds logarithmic in the longest group.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    over_b, over_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    own = n_a + np.arange(n_b)
    up = np.concatenate([n_a + over_b, np.where(ends_a[over_a] == ends_b, own, over_a)]) if n_a else np.zeros(0, np.int64)
    while True:
        further = up[up]
        if np.array_equal(further, up):
            break
        up = further
    is_last = np.zeros(n_a + n_b, dtype=np.int64)
    is_last[up] = 1
    number = np.cumsum(is_last) - 1  # the last tokens are B tokens, in order
    groups = number[up] if n_a else up
    return groups[:n_a], groups[n_a:], int(is_last.sum())


class Aligner:
    """Groups and links of texts, many at once."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.size_a, self.size_b = sizes(a.bytes), sizes(b.bytes)
        # The text of an id with each sign that may follow it: inside a list, at its end, at a text's end.
        self.signed_a = [f"{i}{sign}" for sign in (",", "|") for i in range(len(a.bytes))]
        self.signed = pa.array(self.signed_a + [f"{i}{sign}" for sign in (",", ";", "") for i in range(len(b.bytes))])

    def runs(self, data: bytes) -> list[bytes]:
        """A text cut into runs of about `RUN` bytes, each without the space it begins with."""
        if not self.b.by_word or len(data) <= RUN:
            return [data]
        out, at = [], 0
        while len(data) - at > RUN:
            cut = CUT.search(data, at + RUN)
            if cut is None:
                break
            out.append(data[at : cut.start()])
            at = cut.end()
        return [*out, data[at:]]

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides of all texts that have tokens, and how many each text has on either side.

        Tokens whose bytes are not a space and the text are none.
        """
        owner = [i for i, t in enumerate(texts) if t for _ in self.runs(t)]
        parts = [r for t in texts if t for r in self.runs(t)]
        spelt = [p.decode() for p in parts]
        found = []
        for side, ids in ((self.a, self.a.encode([" " + s for s in spelt])), (self.b, self.b.encode(spelt))):
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int64)
            found.append((flat, counts, *joined(side.bytes, flat, counts)))
        good = np.ones(len(texts), dtype=bool)
        for k, (i, part) in enumerate(zip(owner, parts, strict=True)):
            for _, _, body, at in found:
                if at[k + 1] - at[k] != len(part) + 1 or body[at[k]] != 32 or body[at[k] + 1 : at[k + 1]] != part:
                    good[i] = False
        owners = np.array(owner, dtype=np.int64)
        out = []
        for flat, counts, _, _ in found:
            keep = good[owners] if len(owners) else np.zeros(0, bool)
            out += [flat[np.repeat(keep, counts)], np.bincount(owners[keep], counts[keep], len(texts)).astype(np.int64)]
        return tuple(out)

    def align(self, texts: list[bytes]):
        """Per text: n_a, n_b, n_groups, n_links, its groups spelt out, and its different pairs with their links.

        A pair is one number, the A id times B's vocabulary size plus the B id.
        """
        ids_a, n_a, ids_b, n_b = self.tokens(texts)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        group_a, group_b, groups = labelled(ends_a, ends_b)
        owner = np.repeat(np.arange(len(texts)), n_b)
        last = np.flatnonzero(np.r_[group_b[1:] != group_b[:-1], True]) if groups else np.zeros(0, np.int64)
        n_groups = np.bincount(owner[last], minlength=len(texts))
        spelt = self._spelt(ids_a, group_a, ids_b, group_b, last, n_groups)
        # Between two neighbouring ends of either side lies what one A and one B token share: a link.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.r_[True, ends[1:] != ends[:-1]][: len(ends)]]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        of = owner[at_b] if groups else ends
        n_links = np.bincount(of, minlength=len(texts)) if groups else np.zeros(len(texts), np.int64)
        pair = ids_a[at_a] * len(self.b.bytes) + ids_b[at_b] if groups else ends
        ends_of = np.cumsum(n_links)
        pairs, counts = [], []
        for start, end in zip(ends_of - n_links, ends_of, strict=True):
            p, c = np.unique(pair[start:end], return_counts=True)
            pairs.append(p)
            counts.append(c)
        return n_a, n_b, n_groups, n_links, spelt, pairs, counts

    def _spelt(self, ids_a, group_a, ids_b, group_b, last, n_groups) -> pa.Array:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`: every id is taken with the sign behind it, in order, so the texts lie ready in one buffer."""
        sign_a = np.r_[group_a[1:] != group_a[:-1], True][: len(ids_a)].astype(np.int64)
        sign_b = np.zeros(len(ids_b), dtype=np.int64)
        sign_b[last] = 1
        through = np.cumsum(n_groups)
        sign_b[last[through[n_groups > 0] - 1]] = 2
        key = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(key, kind="stable")
        number = np.concatenate([ids_a + sign_a * len(self.a.bytes), ids_b + sign_b * len(self.b.bytes) + len(self.signed_a)])[order]
        offsets, body = buffers(self.signed.take(pa.array(number)))
        group_end = np.flatnonzero(np.r_[key[order][1:] // 2 != key[order][:-1] // 2, True][: len(key)]) + 1
        cuts = np.r_[0, group_end][np.r_[0, through]]
        return pa.StringArray.from_buffers(len(n_groups), pa.py_buffer(offsets[cuts].astype(np.int32)), body)


def buffers(taken: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Where each value begins, and the bytes of all of them."""
    if not len(taken):
        return np.zeros(1, np.int32), pa.py_buffer(b"")
    _, offsets, body = taken.buffers()
    return np.frombuffer(offsets, np.int32)[taken.offset :], body


def sizes(tokens: pa.Array) -> np.ndarray:
    return np.array([len(t.as_buffer()) if t.is_valid else 0 for t in tokens], dtype=np.int64)


def joined(tokens: pa.Array, ids: np.ndarray, counts: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The bytes of all tokens in one buffer, and where each run's begin."""
    at, body = buffers(tokens.take(pa.array(ids)))
    return memoryview(body).cast("B"), at[np.r_[0, np.cumsum(counts)]]


PARTS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<int>"


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`, A and B ids in order), its different id pairs and how many links each has.

    Rows are independent: no shuffle, and a worker holds one Arrow batch and
    the tokens of about `RUN` bytes of text, or of one longer text.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches):
        tools = aligner(a, b)
        for batch in batches:
            for rows in slices(batch, size=RUN):
                texts = rows.column(1).fill_null("").cast(pa.binary()).to_pylist()
                n_a, n_b, groups, links, spelt, pairs, counts = tools.align(texts)
                ends = pa.array(np.r_[0, np.cumsum([len(p) for p in pairs])], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), t)) for x, t in ((pairs, pa.int64()), (counts, pa.int32()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)], spelt, *lists], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {PARTS}")


def pair_counts(found: DataFrame, b_size: int) -> DataFrame:
    """Links of every id pair over all documents: pair, count, best (whether no pair of its B id has more)."""
    each = found.select(F.inline(F.arrays_zip("pairs", "links"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("count"))
    counts = kept(each.withColumn("_b", F.col("pair") % b_size), "pair-counts")
    most = counts.groupBy("_b").agg(F.max("count").alias("most"))  # a row per id of B's vocabulary
    return counts.join(F.broadcast(most), "_b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups; with ``digest`` groups_sha256 for the last.

    A text is encoded by A with a space before it and by B, which adds one.  A
    null or empty text, and one whose tokens of either side do not spell a
    space and the text, has no tokens: zeros and empty groups.  A text may
    have any length; it is encoded in runs that give the same tokens.  Repeated
    rows and null identifiers are rows like others, other columns are ignored
    whatever their names, an empty table stays empty.

    An id pair found everywhere would be one task's work in a join, so pairs
    that hold a `FREQUENT`-th of all links, which there are no more than
    `FREQUENT` of, go to every executor; the others are joined by a shuffle in
    which no key has more rows than that.
    """
    b_size = len(aligner(a, b).b.bytes)
    found = aligned(docs, key, text, a, b).withColumn("_row", F.monotonically_increasing_id())
    if digest:
        found = found.withColumn("groups_sha256", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")).drop("groups")
    found = kept(found, "aligned")
    counts = kept(pair_counts(found, b_size), "pairs")
    share = counts.agg(F.sum("count") / F.lit(FREQUENT)).scalar()
    frequent = kept(counts.where(F.col("count") >= share), "frequent-pairs")
    rows = found.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("n"))))
    marked = rows.join(narrow(frequent, FREQUENT), "pair", "left")
    known = marked.where("count IS NOT NULL")
    rare = marked.where("count IS NULL").select("pair", "_row", "n").join(counts.where(F.col("count") < share), "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    columns = ["_row", "n", "count", "best"]
    totals = known.select(*columns).unionAll(rare.select(*columns)).groupBy("_row").agg(*sums)
    out = found.drop("pairs", "links").join(totals, "_row", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256" if digest else "groups")
