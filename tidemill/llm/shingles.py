"""Word shingles of a batch of texts, hashed without a loop over words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at a time; a longer text is hashed alone.
CHUNK = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = []


def _values() -> np.ndarray:
    """A 64-bit value per byte, A-Z as a-z."""
    v = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], dtype=np.uint64)
    v[65:91] = v[97:123]
    return v


_VALUE = _values()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, dtype=np.uint64)], dtype=np.uint64) for x in (_ODD, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each begins; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: int = 1, size: int = CHUNK):
    """Runs of rows with about `size` bytes of text, or a single longer one: what a worker has in hand at a time."""
    off = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(off, off[row] + size, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words `[^\\x20\\x09-\\x0D]+`, and where each row's words begin."""
    inside = ~_SPACE[data]
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    edges = off[:-1][off[:-1] < len(data)]
    before[edges] = False
    after[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    power, inverse = _powers(max(CHUNK, len(data)) + 1)
    total = np.r_[np.uint64(0), np.cumsum(_VALUE[data] * power[: len(data)], dtype=np.uint64)]
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, off)


def row_sets(texts: pa.Array, size: int = 4):
    """Per text its distinct shingles as sorted int64; a text of fewer words has its whole sequence as one."""
    data, off = raw(texts)
    row = 0
    while row < len(off) - 1:
        end = max(row + 1, int(np.searchsorted(off, off[row] + CHUNK, side="right")) - 1)
        w, at = words(data[off[row] : off[end]], off[row : end + 1] - off[row])
        h = np.zeros(max(0, len(w) - size + 1), dtype=np.uint64)
        for k in range(size):
            h = h * _ODD + w[k : len(w) - size + 1 + k]
        h = mix(h).view(np.int64)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(h[a : b - size + 1])
            elif b == a:
                yield h[:0]
            else:
                short = np.uint64(b - a)
                for x in w[a:b]:
                    short = np.uint64((int(short) * int(_ODD) + int(x)) & 0xFFFFFFFFFFFFFFFF)
                yield mix(np.array([short], dtype=np.uint64)).view(np.int64)
        row = end


def set_name(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))
