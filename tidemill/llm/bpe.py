"""Byte-level BPE by prefix dynamic programming."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shingles import slices

#: Entries a worker remembers of each kind; beyond that it starts anew. Only speed depends on it.
REMEMBERED = 200_000
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


class Vocabulary:
    """Ranks of byte strings, and which pairs of tokens may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes = {r: t for t, r in self.rank.items()}
        self.size = {r: len(t) for r, t in self.bytes.items()}
        self.packed = {r: np.array([r], dtype="<u4").tobytes() for r in self.bytes}
        # Tokens by their bytes: a node leads from a byte to the next, and from -1 to the token that ends there.
        self.root: dict = {}
        for token, data in self.bytes.items():
            node = self.root
            for byte in data:
                node = node.setdefault(byte, {})
            node[-1] = token
        self._fits: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, piece: bytes, least: int = 1) -> list[int]:
        """The defining procedure, for short pieces: merge the leftmost pair of lowest rank until `least` parts or no such pair are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            best = min((self.rank.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives the token; None for a byte."""
        if token not in self._halves:
            parts = self.merged(self.bytes[token], 2) if len(self.bytes[token]) > 1 else []
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return len(self.bytes[token]) == 1 or self.halves(token) is not None

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens; left is -1 at the beginning of a piece."""
        known = self._fits.get(left << 32 | right)
        if known is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            known = self._fits[left << 32 | right] = self.reachable(right) and (left < 0 or (self.reachable(left) and self._stay_apart(left, right)))
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undoes the merges beside the boundary, latest first; at each step the two neighbours there must not have merged before the step undone.

        Of equal ranks the leftmost merge comes first: before one on the
        boundary's right side, after one on its left.
        """
        until = None  # rank of the merge undone last, and whether on the right
        while True:
            across = self.rank.get(self.bytes[left] + self.bytes[right])
            if across is not None and (until is None or across < until[0] or (across == until[0] and until[1])):
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                until, left = (left, False), a[1]
            else:
                until, right = (right, True), b[0]


class Prefixes:
    """The last token of every prefix of one piece.

    An encoding is right exactly if each neighbouring pair of its tokens is,
    so the last token of a prefix is the one token ending there that fits the
    last token of what lies before it, and there is no second such.  Appending
    bytes leaves the entries so far as they are; cutting keeps those before
    the cut.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        #: For each prefix, where tokens may have begun that go on behind it, and the nodes reached.
        self.open: list[list[tuple[int, dict]]] = [[]]

    def append(self, more: bytes) -> Prefixes:
        v, end = self.vocabulary, len(self.data)
        self.data += more
        last, opened, root, known = self.last, self.open, v.root, v._fits.get
        now = opened[-1]
        for byte in more:
            grown, found = [], None
            for at, begun in now:
                node = begun.get(byte)
                if node is not None:
                    grown.append((at, node))
                    if found is None and -1 in node:
                        token = node[-1]
                        fits = known(last[at] << 32 | token)
                        if fits or (fits is None and v.fits(last[at], token)):
                            found = token
            node = root[byte]
            grown.append((end, node))
            if found is None:  # one token fits, so the byte's own does
                found = node[-1]
            last.append(found)
            opened.append(grown)
            now = grown
            end += 1
        return self

    def cut(self, length: int) -> Prefixes:
        self.data = self.data[:length]
        del self.last[length + 1 :], self.open[length + 1 :]
        return self

    def become(self, data: bytes) -> Prefixes:
        """Another piece, from the longest common beginning on."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        return self.cut(same).append(data[same:])

    def ids(self) -> list[int]:
        out, at, size = [], len(self.data), self.vocabulary.size
        while at:
            token = self.last[at]
            out.append(token)
            at -= size[token]
        return out[::-1]


class Encoder:
    """Encodes texts piece by piece, each match of the pattern by itself."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.vocabulary, self.pattern = Vocabulary(path), regex.compile(pattern)
        self._known: dict[str, bytes] = {}

    def piece(self, data: bytes) -> list[int]:
        """A piece that is a token is that token; others by their prefixes."""
        token = self.vocabulary.rank.get(data)
        return [token] if token is not None else Prefixes(self.vocabulary).append(data).ids()

    def _learn(self, pieces: set[str]) -> None:
        """Encodes new pieces in sorted order, so each begins with the entries of the one before as far as they agree."""
        if len(self._known) + len(pieces) > REMEMBERED:
            self._known.clear()
        rank, packed, at = self.vocabulary.rank, self.vocabulary.packed, Prefixes(self.vocabulary)
        for data in sorted(p.encode() for p in pieces):
            token = rank.get(data)
            ids = (token,) if token is not None else at.become(data).ids()
            self._known[data.decode()] = b"".join([packed[i] for i in ids])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        wanted = set().union(*split)
        new = wanted - self._known.keys()
        if len(self._known) + len(new) > REMEMBERED:
            new = wanted
        self._learn(new)
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class Edited:
    """A text whose ids stay known while it is edited.

    Pieces from two before the edit are split anew until a piece begins where
    one began before, beyond the edit; the others keep their ids.  The piece
    an append grows keeps its prefix entries.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.renewed = encoder, "", 0
        self.starts: list[int] = []
        self.held: list[Prefixes] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        first = max(0, int(np.searchsorted(self.starts, start, side="right")) - 2)
        old_tail = {s + shift: i for i, s in enumerate(self.starts) if s > end}
        at = self.starts[first] if first < len(self.starts) else 0
        before = dict(zip(self.starts[first:], self.held[first:], strict=True))
        starts, held, rest = self.starts[:first], self.held[:first], None
        self.renewed = 0
        for match in self.encoder.pattern.finditer(text, at):
            if match.start() in old_tail and match.start() > start + len(new):
                rest = old_tail[match.start()]
                break
            body = match[0].encode()
            known = before.get(match.start()) if match.start() <= start else None
            known = known or Prefixes(self.encoder.vocabulary)
            self.renewed += known.data != body
            held.append(known.become(body))
            starts.append(match.start())
        if rest is not None:
            starts += [s + shift for s in self.starts[rest:]]
            held += self.held[rest:]
        self.text, self.starts, self.held = text, starts, held

    def ids(self) -> list[int]:
        return [i for p in self.held for i in ([self.encoder.vocabulary.rank[p.data]] if p.data in self.encoder.vocabulary.rank else p.ids())]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file, which every machine has at this path."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_table(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (array<int>).  Rows are independent: no shuffle, one Arrow batch in memory."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for rows in slices(batch):
                ids = [np.frombuffer(x, dtype="<i4") for x in enc.encode_all([t or "" for t in rows.column(1).to_pylist()])]
                ends = np.cumsum([0, *map(len, ids)])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))], names=["doc_id", "ids"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 of the ids encoded and decoded again.

    Null text is empty: no ids.  A text may have any length; it is encoded
    whole.  Repeated rows and null identifiers are rows like others, other
    columns are ignored whatever their names, an empty table stays empty.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            n, sums, back = [], [], []
            for rows in slices(batch):
                for ids in enc.encode_all([t or "" for t in rows.column(1).to_pylist()]):
                    n.append(len(ids) // 4)
                    sums.append(hashlib.sha256(ids).hexdigest())
                    back.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

