"""Periodic runs of words by online dyadic square catching."""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.arrays import let
from tidemill.llm.shingles import mix, slices

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Level of the smallest blocks; they catch every period below twice their size.
LOWEST = 3
#: Bytes of text split into words at a time, and words joined at a time.
CHUNK = 1 << 20
SPACES = r"[\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Catcher:
    """Finds the periodic runs of texts while words are appended.

    Level k cuts the stream of words into blocks of 2^k.  A completed block is
    a catcher: every later suffix of 2^k words that begins in the next block
    is compared with it, and a match at distance q, 2^k <= q < 2^(k+1), is a
    square (on the lowest level also 0 < q < 2^k, within the block).  A run of
    three periods q or more holds such a block and its repetition whole,
    wherever it begins.  A suffix goes by its name, 64 bits mixed from the
    names of its halves; the words of a match are then compared, so names only
    propose.  Squares at one distance merge into the stretch they lie in, and
    a square inside a stretch whose period divides its distance is dropped
    unseen.  A stretch that reaches the end of the words stays open: the next
    words are compared with those one period before.
    """

    def __init__(self, words: int = LEAST_WORDS, periods: int = LEAST_PERIODS):
        if periods < 3 or words < 3 << LOWEST:
            raise ValueError(f"runs need 3 periods and {3 << LOWEST} words to hold a block with its repetition")
        self.least_words, self.least_periods = words, periods
        self.count = 0
        self._ids, self._first = np.zeros(64, dtype=np.int64), np.zeros(64, dtype=np.int64)
        self._names: list[tuple[int, np.ndarray]] = []  # per level, what later words need: (position of the first, names)
        self._longest = 0
        self._open: list[tuple[int, int]] = []
        self.runs: dict[tuple[int, int], int] = {}  # (start, end) to the period; the end is exclusive

    def append(self, ids, start: int = 0) -> list[tuple[int, int, int]]:
        """Appends words, as numbers, of the text that began at word ``start`` of the stream; gives the runs (start, end, period) that are new or grew."""
        return self.append_texts(np.asarray(ids), np.full(len(ids), start))

    def append_texts(self, ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """Appends words of several texts; ``starts`` says for every word where its text begins."""
        old, n = self.count, self.count + len(ids)
        while len(self._ids) < n:
            self._ids, self._first = (np.concatenate([x, np.zeros_like(x)]) for x in (self._ids, self._first))
        self._ids[old:n], self._first[old:n] = ids, starts
        self.count = n
        if n > old:
            self._longest = max(self._longest, int((np.arange(old, n) - self._first[old:n]).max()) + 1)
        before = set(self.runs.items())
        stretches = self._grow(old)
        fresh, fresh_at, level = mix(self._ids[old:n].astype(np.uint64)), old, 0
        while len(fresh):
            if level == len(self._names):
                self._names.append((0, np.zeros(0, dtype=np.uint64)))
            base, tail = self._names[level]
            names = np.concatenate([tail, fresh])
            if level >= LOWEST and 2 << level <= self._longest:
                self._catch(names, base, fresh_at, level, stretches)
            half = 1 << level
            done = max(0, old - 2 * half + 1)  # names of the next level known so far
            right = names[done - base + half :]
            left = names[done - base : done - base + len(right)]
            drop = max(0, n - 4 * half - base)
            self._names[level] = (base + drop, names[drop:])
            fresh, fresh_at, level = mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(level + 1)), done, level + 1
        self._open = [(a, d) for a, b, d in stretches if b == n]
        return sorted((s, e, p) for (s, e), p in set(self.runs.items()) - before)

    def _grow(self, old: int) -> list[tuple[int, int, int]]:
        """Open stretches over the new words."""
        out = []
        for a, d in self._open:
            b = self._right(a, old, d)
            if self.runs.get((a, old)) == d and b > old:
                del self.runs[a, old]
            self._report(a, b, d)
            out.append((a, b, d))
        return out

    def _catch(self, names: np.ndarray, base: int, begin: int, level: int, stretches: list) -> None:
        """Every suffix of 2^level words from `begin` on against the block it began in, on the lowest level, and the one before."""
        size = 1 << level
        at = np.arange(begin, base + len(names))
        own = at >> level << level
        for block in (own, own - size) if level == LOWEST else (own - size,):
            ok = (block >= base) & (block < at)
            s, t = block[ok], at[ok]
            hit = names[s - base] == names[t - base]
            s, t = s[hit], t[hit]
            one_text = self._first[s] == self._first[t + size - 1]
            self._merge(s[one_text], (t - s)[one_text], size, stretches)

    def _merge(self, start: np.ndarray, q: np.ndarray, size: int, stretches: list) -> None:
        """Squares (block, distance) into stretches; smaller distances of a block come first."""
        if not len(start):
            return
        order = np.lexsort((q, start))
        start, q = start[order], q[order]
        keep = np.ones(len(start), dtype=bool)

        def explain(a: int, b: int, d: int) -> None:
            i, j = np.searchsorted(start, (a, b))
            keep[i:j] &= (start[i:j] + q[i:j] + size > b) | (q[i:j] % d != 0)

        for known in stretches:
            explain(*known)
        i = 0
        while i < len(start):
            some = np.flatnonzero(keep[i : i + 4096])
            i += int(some[0]) if len(some) else 4096
            if len(some):
                s, d = int(start[i]), int(q[i])
                if np.array_equal(self._ids[s : s + size], self._ids[s + d : s + d + size]):
                    a, b = self._left(s, d), self._right(s, s + d + size, d)
                    self._report(a, b, d)
                    stretches.append((a, b, d))
                    explain(a, b, d)
                i += 1

    def _left(self, a: int, d: int) -> int:
        """Where the stretch of period d that holds word a begins."""
        ids, first, step = self._ids, int(self._first[a]), 16
        while a > first:
            low = max(first, a - step)
            differs = np.flatnonzero(ids[low:a] != ids[low + d : a + d])
            if len(differs):
                return low + int(differs[-1]) + 1
            a, step = low, 2 * step
        return a

    def _right(self, a: int, b: int, d: int) -> int:
        """Where the stretch of period d from word a, known up to b, ends."""
        ids, of, n, step = self._ids, self._first, self.count, 16
        while b < n:
            high = min(n, b + step)
            differs = np.flatnonzero((ids[b:high] != ids[b - d : high - d]) | (of[b:high] != of[a]))
            if len(differs):
                return b + int(differs[0])
            b, step = high, 2 * step
        return b

    def _report(self, a: int, b: int, d: int) -> None:
        """A stretch long enough is a run; of several distances of one stretch the smallest is its period."""
        if b - a >= max(self.least_words, self.least_periods * d):
            self.runs[a, b] = min(d, self.runs.get((a, b), d))


class Numbers(dict):
    """Words to numbers, in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_numbers(data: bytes, numbers: Numbers) -> np.ndarray:
    """The words of a text as numbers; a long text is split piece by piece, so only its different words are held."""
    out, at = [np.zeros(0, dtype=np.int64)], 0
    while at < len(data):
        gap = _SPACE.search(data, at + CHUNK) if len(data) - at > CHUNK else None
        end = gap.start() if gap else len(data)
        # bytes.split knows no other white space than these six bytes.
        out.append(np.fromiter(map(numbers.__getitem__, data[at:end].split()), np.int64))
        at = end
    return np.concatenate(out)


def spell(ids: np.ndarray, words: list[bytes]) -> bytes:
    return b" ".join([b" ".join(map(words.__getitem__, ids[i : i + CHUNK].tolist())) for i in range(0, len(ids), CHUNK)])


def find_runs(texts: list[bytes], words: int = LEAST_WORDS, periods: int = LEAST_PERIODS):
    """Per text: number of words, runs (start, length, period) by start and period, and the text without the repetitions."""
    numbers = Numbers()
    ids = [word_numbers(t, numbers) for t in texts]
    counts = np.array([len(x) for x in ids], dtype=np.int64)
    ends = np.cumsum(counts)
    flat, begins = np.concatenate([np.zeros(0, np.int64), *ids]), np.repeat(ends - counts, counts)
    catcher = Catcher(words, periods)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, p in catcher.append_texts(flat, begins):
        i = int(np.searchsorted(ends, s, side="right"))
        begin = int(ends[i] - counts[i])
        found[i].append((s - begin, e - s, p))
    spelt = list(numbers)
    collapsed = []
    for own, runs in zip(ids, found, strict=True):
        runs.sort(key=lambda r: (r[0], r[2]))
        keep = np.ones(len(own), dtype=bool)
        for s, length, p in runs:
            keep[s + p : s + length] = False
        collapsed.append(spell(own[keep] if runs else own, spelt))
    return counts, found, collapsed


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods, exactly; of equal ones the first, then the one of smaller period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per document: doc_id, n_words, runs (by start, then period), strongest (null without a run), collapsed.

    Words are stretches without the six ASCII white spaces; a run is a stretch
    of least period q, of ``words`` words and ``periods`` periods at least,
    that no neighbouring word continues.  ``collapsed`` holds the words that
    lie behind the first period of no run, joined by a space.  Null text is
    empty: no words, no runs.  A text may have any length and is searched
    whole; a worker holds the numbers of one batch's words.  Repeated rows and
    null identifiers are rows like others, other columns are ignored whatever
    their names, an empty table stays empty.  Rows are independent: no shuffle.
    """
    kind = dict(docs.dtypes)[key]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def as_run(run):
        return dict(zip(("start", "length", "period"), run, strict=True)) if run else None

    def search(batches):
        for batch in batches:
            for rows in slices(batch):
                counts, found, collapsed = find_runs(rows.column(1).fill_null("").cast(pa.binary()).to_pylist(), words, periods)
                columns = [
                    rows.column(0), pa.array(counts), pa.array([[as_run(r) for r in runs] for runs in found], pa.list_(run_type)),
                    pa.array([as_run(strongest(runs)) for runs in found], run_type), pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    whole = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return whole.mapInArrow(search, f"doc_id {kind}, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")


def planted(key: Column, text: Column) -> Column:
    """The contract's text: in every tenth document, by CRC-32 of its identifier, the words from some place on repeat with some period."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(F.struct(words.alias("w"), a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(
            x["w"], lambda w, i: F.when(i < x["a"], w).otherwise(F.get(x["w"], (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " "))

    split = F.filter(F.split(text, SPACES), lambda w: w != "")
    return F.when(h % 10 == 0, let(split, repeat)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of `periodic_runs`."""
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
