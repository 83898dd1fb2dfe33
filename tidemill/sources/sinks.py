"""Writing curated datasets, pictures, and manifests that several runs add to."""

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.hashing import as_list
from tidemill.operators.curate import link_once
from tidemill.plans.shared import create_once, file_system, names, read_file, write_file


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 1_000_000) -> None:
    """Parquet laid out as ``split=/label=`` so later reads of a class prune folders.

    Rebalancing by the folder columns keeps the file count near the folder
    count; adaptive execution splits a folder that is too large for one task.
    """
    laid_out = df.hint("rebalance", "split", "label")
    laid_out.write.partitionBy("split", "label").option("maxRecordsPerFile", rows_per_file).mode(mode).parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def png(pixels: np.ndarray) -> bytes:
    """An 8-bit picture (height, width, 1 or 3) as a PNG file."""
    height, width, channels = pixels.shape
    lines = np.zeros((height, 1 + width * channels), dtype=np.uint8)
    lines[:, 1:] = pixels.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def write_images(df: DataFrame, root: str) -> int:
    """``split, label, name, height, width, channels, pixels`` (0 to 255) as ``<root>/<split>/<label>/<name>.png``; how many there are.

    Tasks write the files themselves; a repeated task writes the same ones.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(root)
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{base}/{row['split']}/{row['label']}"
                files.create_dir(folder, recursive=True)
                picture = np.array(row["pixels"], dtype=np.uint8).reshape(row["height"], row["width"], row["channels"])
                write_file(files, f"{folder}/{row['name']}.png", png(picture))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return df.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


class Manifest:
    """Linked entries as a versioned table; a version is a list of data folders, made by one run and never changed.

    A run writes its new entries into a folder of its own and then tries to
    create the next version.  If another run was first, the entries it added
    are taken out of this run's and the next number is tried.  What a run wrote
    before it died is in no version.
    """

    def __init__(self, spark: SparkSession, path: str, key, schema: T.StructType | str):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), as_list(key)
        self.schema = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
        self.files, self.base = file_system(self.path)
        self.files.create_dir(f"{self.base}/_versions", recursive=True)

    def version(self) -> int:
        """The latest version; 0 before the first."""
        found = [int(n[:-5]) for n in names(self.files, f"{self.base}/_versions") if n.endswith(".json") and n[:-5].isdigit()]
        return max(found, default=0)

    def folders(self, version: int) -> list[str]:
        return json.loads(read_file(self.files, f"{self.base}/_versions/{version:012d}.json")) if version else []

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.folders(self.version() if version is None else version))

    def prepare(self, df: DataFrame) -> tuple[int, str]:
        """Writes the entries of ``df`` whose key the latest version lacks; gives that version and the folder."""
        seen = self.version()
        fresh = link_once(df.select(*self.schema.names), self.read(seen), self.keys).where(F.col("status") == "linked").drop("status")
        folder = f"data-{uuid.uuid4().hex}"
        fresh.write.parquet(f"{self.path}/{folder}")
        return seen, folder

    def commit(self, seen: int, folder: str) -> int:
        """Makes a prepared folder part of the next version; the version it became."""
        while True:
            now = self.version()
            if now > seen:  # others committed since: their entries are linked already
                before, after = self.folders(seen), self.folders(now)
                added = [f for f in after if f not in before]
                rest = link_once(self._rows([folder]), self._rows(added), self.keys).where(F.col("status") == "linked").drop("status")
                seen, folder = now, f"data-{uuid.uuid4().hex}"
                rest.write.parquet(f"{self.path}/{folder}")
            listing = json.dumps([*self.folders(seen), folder]).encode()
            if create_once(self.files, f"{self.base}/_versions/{seen + 1:012d}.json", listing):
                return seen + 1

    def append(self, df: DataFrame) -> int:
        """Adds each entry whose key is not linked yet, once; the version that holds them."""
        return self.commit(*self.prepare(df))
