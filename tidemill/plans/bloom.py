"""Bloom filters: keys of one side drop rows of the other before a shuffle."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import as_list

#: Bits per key asked for, bits of a filter at most (64 MB on every executor), bytes of the pieces tasks merge.
BITS_PER_KEY, MOST_BITS, PIECE = 12, 1 << 29, 4096
PIECES = "piece int, bits binary"


@dataclass
class Bloom:
    """A bit array: a key is in it if all its bits are set.  It never misses a key; how often it lets others through is ``rate``."""

    sent: Broadcast
    size: int
    hashes: int
    set_bits: int

    @property
    def rate(self) -> float:
        """Share of other keys it lets through, from the bits that are set."""
        return (self.set_bits / self.size) ** self.hashes

    def keep(self, df: DataFrame, on) -> DataFrame:
        """The rows whose key may be in the filter: no shuffle, only a hash of the key enters Python."""
        sent, size, hashes = self.sent, self.size, self.hashes

        @F.arrow_udf("boolean")
        def may_hold(keys: pa.Array) -> pa.Array:
            bits = np.frombuffer(sent.value, dtype=np.uint8)
            found = np.ones(len(keys), dtype=bool)
            for place in places(keys.to_numpy(zero_copy_only=False), size, hashes):
                found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            return pa.array(found)

        return df.where(may_hold(key_hash(on)))


def key_hash(on):
    """64 bits of a key; NULL is a key like others."""
    return F.xxhash64(*[F.struct(F.col(c)) if isinstance(c, str) else F.struct(c) for c in as_list(on)])


def places(keys: np.ndarray, size: int, hashes: int) -> Iterator[np.ndarray]:
    """The bits of each key, by double hashing (Kirsch & Mitzenmacher 2006); the size is a power of two."""
    first = keys.astype(np.int64).view(np.uint64)
    second = (first >> np.uint64(32) | first << np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    for i in range(hashes):
        yield ((first + np.uint64(i) * second) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def build(keys: DataFrame, on, bits_per_key: int = BITS_PER_KEY) -> Bloom:
    """A filter of the keys of a table of any size.

    Every task sets bits in an array of its own and hands on its pieces that
    are not empty; pieces are merged on the cluster, and only the merged array,
    of bounded size, passes the driver.
    """
    rows = keys.count()
    size = min(MOST_BITS, 1 << max(15, math.ceil(math.log2(max(1, rows * bits_per_key)))))
    hashes = max(1, min(8, round(size / max(1, rows) * math.log(2))))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, dtype=np.uint8)
        for batch in batches:
            for place in places(batch.column(0).to_numpy(zero_copy_only=False), size, hashes):
                np.bitwise_or.at(bits, place >> 3, (1 << (place & 7)).astype(np.uint8))
        for piece, part in enumerate(bits.reshape(-1, min(PIECE, len(bits)))):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([part.tobytes()])], names=["piece", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        merged = None
        for body in table.column("bits"):
            part = np.frombuffer(body.as_buffer(), dtype=np.uint8)
            merged = part if merged is None else merged | part
        return pa.table({"piece": table.column("piece").slice(0, 1), "bits": pa.array([merged.tobytes()], pa.binary())})

    filled = keys.select(key_hash(on).alias("h")).mapInArrow(fill, PIECES)
    whole = np.zeros(size // 8, dtype=np.uint8)
    step = min(PIECE, len(whole))
    for row in filled.groupBy("piece").applyInArrow(merge, PIECES).toLocalIterator():
        whole[row.piece * step:(row.piece + 1) * step] = np.frombuffer(row.bits, dtype=np.uint8)
    count = int(np.bitwise_count(whole).sum())
    return Bloom(keys.sparkSession.sparkContext.broadcast(whole.tobytes()), size, hashes, count)
