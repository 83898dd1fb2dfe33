"""Token counts of flat token files by a separator scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.bpe import encoder
from tidemill.llm.shingles import slices

END = 50256  # the free id after the vocabulary's last
WIDTH = 2  # bytes of an id, little-endian unsigned
BLOCK = 1 << 20
#: Blocks of a file whose separators are summed together first.
RUN = 1024
LAYOUT = "file string, block long, payload binary"


def flat_files(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, block: int = BLOCK) -> DataFrame:
    """Token files as rows (file, block, payload, keys): ids of one document after another, END behind each, cut every `block` bytes.

    One file per input partition.  Blocks know nothing of documents.  Rows
    with negative block numbers are the files' side lists: the identifiers
    (`keys`) in file order; row -1 - k holds those of the k-th part read.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches):
        enc, name = encoder(path), f"part-{TaskContext.get().partitionId():06d}"
        end, rest, number, parts = np.array([END], "<u4").tobytes(), bytearray(), 0, 0

        def row(n, payload, keys):
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([payload], pa.binary()), keys], names=["file", "block", "payload", "keys"])

        none = None
        largest = max(enc.vocabulary.bytes)
        if END in enc.vocabulary.bytes or max(largest, END) >= 1 << 8 * WIDTH:
            raise ValueError(f"ids up to {largest} and the separator {END} need {WIDTH} bytes and an id of its own")
        for batch in batches:
            for rows in slices(batch):
                ids = np.frombuffer(b"".join([x + end for x in enc.encode_all([t or "" for t in rows.column(1).to_pylist()])]), "<u4")
                rest += ids.astype(f"<u{WIDTH}").tobytes()
                parts += 1
                if none is None:
                    none = pa.array([None], pa.list_(rows.column(0).type))
                yield row(-parts, None, pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(0)))
                while len(rest) >= block:
                    yield row(number, bytes(rest[:block]), none)
                    del rest[:block]
                    number += 1
        if rest:
            yield row(number, bytes(rest), none)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"{LAYOUT}, keys array<{kind}>")


def read_flat(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Blocks (file, block, payload) of raw token files; a file is read whole by one task, so shards should stay below some hundred MB."""

    def run(batches):
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = body.as_py()
                for at in range(0, len(data), block):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at // block], pa.int64()), pa.array([data[at : at + block]], pa.binary())], names=["file", "block", "payload"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, LAYOUT)


def scanned(blocks: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """Per block: file, block, n_ends, head (ids up to the first separator), inner (lengths between separators), tail (ids behind the last)."""

    def run(batches):
        for batch in batches:
            for name, number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = np.frombuffer(body.as_buffer() or b"", dtype=f"<u{width}")
                ends = np.flatnonzero(ids == end)
                inner = np.diff(ends) - 1
                head = int(ends[0]) if len(ends) else 0
                tail = len(ids) - (int(ends[-1]) + 1 if len(ends) else 0)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([number], pa.int64()), pa.array([len(ends)], pa.int64()), pa.array([head], pa.int64()), pa.array([inner], pa.list_(pa.int64())), pa.array([tail], pa.int64())], names=["file", "block", "n_ends", "head", "inner", "tail"])

    shape = "file string, block long, n_ends long, head long, inner array<long>, tail long"
    return blocks.where("payload IS NOT NULL").select("file", "block", "payload").mapInArrow(run, shape)


def count_tokens(blocks: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """One row per document of the files: file, ordinal (from 0), n_tokens, terminated.

    A prefix scan over the blocks' separator counts, first by runs of blocks
    and then within them, tells each block the ordinal it begins with; only
    its first and last pieces meet those of other blocks, however many a
    document spans.  Ids behind a file's last separator are a document that is
    not terminated.  Blocks must end between ids; an empty or null block adds
    nothing, files without blocks give no rows.
    """
    found = scanned(blocks, end, width).withColumn("run", F.floor(F.col("block") / RUN))
    runs = found.groupBy("file", "run").agg(F.sum("n_ends").alias("ends"))
    before = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "run", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("run_base"))
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("before", F.coalesce(F.sum("n_ends").over(inside), F.lit(0))).join(runs, ["file", "run"])
    placed = placed.withColumn("base", F.col("run_base") + F.col("before"))
    inner = placed.select("file", "base", F.posexplode("inner").alias("i", "n_tokens")).select("file", (F.col("base") + F.col("i") + 1).alias("ordinal"), "n_tokens", F.lit(True).alias("terminated"))
    ends = F.array(F.struct(F.col("base").alias("ordinal"), F.col("head").alias("n"), (F.col("n_ends") > 0).alias("ended")), F.struct((F.col("base") + F.col("n_ends")).alias("ordinal"), F.col("tail").alias("n"), F.lit(False).alias("ended")))
    pieces = placed.select("file", F.explode(ends).alias("p")).where("p.ended OR p.n > 0")
    stitched = pieces.groupBy("file", F.col("p.ordinal").alias("ordinal")).agg(F.sum("p.n").alias("n_tokens"), F.max("p.ended").alias("terminated"))
    return inner.union(stitched)


def document_tokens(files: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """Counts joined to the side lists of `flat_files`: doc_id, file, ordinal, n_tokens."""
    sides = files.where("block < 0").select("file", (-F.col("block")).alias("part"), F.size("keys").alias("n"), "keys")
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sides = sides.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    named = sides.select("file", "first", F.posexplode("keys").alias("i", "doc_id")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return count_tokens(files.where("block >= 0"), end, width).join(named, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
