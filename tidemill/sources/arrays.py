"""Packaged array files as a Spark data source, read and written by byte ranges.

A dataset is a set of equally long arrays, one file each: images, labels, keys.
Either the files are named (the usual packaged form: NPY or IDX), or a folder
holds shards that tasks wrote, with a list of the shards that were committed.
"""

import ast
import json
import math
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidemill.plans.shared import file_system, read_file, write_file

FORMAT = "array_files"
LISTING = "_shards.json"
#: Bytes of its widest array a task reads, and bytes of an Arrow batch.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
# Element types of IDX files by their code, and the Spark type that holds each kind of number.
IDX_TYPES = {8: ">u1", 9: ">i1", 11: ">i2", 12: ">i4", 13: ">f4", 14: ">f8"}
SPARK_TYPES = {"b1": T.BooleanType(), "i1": T.ByteType(), "u1": T.ShortType(), "i2": T.ShortType(), "u2": T.IntegerType(), "i4": T.IntegerType(),
               "u4": T.LongType(), "i8": T.LongType(), "f4": T.FloatType(), "f8": T.DoubleType()}
NUMPY_TYPES = {"boolean": "|b1", "tinyint": "|i1", "smallint": "<i2", "int": "<i4", "bigint": "<i8", "float": "<f4", "double": "<f8"}


@dataclass(frozen=True)
class Header:
    """Where the numbers of an array file begin, and how they lie."""

    dtype: str
    shape: tuple[int, ...]
    start: int

    @property
    def row_values(self) -> int:
        return math.prod(self.shape[1:])

    @property
    def row_bytes(self) -> int:
        return self.row_values * np.dtype(self.dtype).itemsize

    @property
    def spark_type(self) -> T.DataType:
        kind = np.dtype(self.dtype).str[1:]
        if kind not in SPARK_TYPES:
            raise ValueError(f"array files of type {self.dtype} are not supported")
        return T.ArrayType(SPARK_TYPES[kind]) if len(self.shape) > 1 else SPARK_TYPES[kind]


def read_header(path: str) -> Header:
    """The header of an NPY (versions 1 to 3, row-major) or IDX file."""
    files, inside = file_system(path)
    with files.open_input_file(inside) as f:
        magic = f.read(8)
        if magic[:6] == b"\x93NUMPY":
            size = f.read(2 if magic[6] == 1 else 4)
            length = int.from_bytes(size, "little")
            spec = ast.literal_eval(f.read(length).decode("latin1" if magic[6] < 3 else "utf-8"))
            if spec["fortran_order"] and len(spec["shape"]) > 1:
                raise ValueError(f"{path} is column-major, so its rows are no byte ranges")
            if not spec["shape"]:
                raise ValueError(f"{path} holds a single number")
            header = Header(np.dtype(spec["descr"]).str, tuple(spec["shape"]), 8 + len(size) + length)
        elif magic[:2] == b"\0\0" and magic[2] in IDX_TYPES and magic[3]:
            sizes = (magic + f.read(4 * magic[3] - 4))[4:] if magic[3] > 1 else magic[4:]
            header = Header(IDX_TYPES[magic[2]], struct.unpack(f">{magic[3]}I", sizes), 4 + 4 * magic[3])
        else:
            raise ValueError(f"{path} is neither NPY nor IDX")
        if f.size() != header.start + header.shape[0] * header.row_bytes:
            raise ValueError(f"{path} has {f.size()} bytes, its header tells of {header.start + header.shape[0] * header.row_bytes}")
    return header


def npy(values: np.ndarray) -> bytes:
    """A whole NPY file of row-major numbers."""
    spec = f"{{'descr': {values.dtype.str!r}, 'fortran_order': False, 'shape': {values.shape!r}, }}"
    length = -(-(10 + len(spec) + 1) // 64) * 64 - 10
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", length) + spec.ljust(length - 1).encode("latin1") + b"\n" + np.ascontiguousarray(values).tobytes()


@dataclass
class Range(InputPartition):
    """Rows of one shard, as byte ranges of its arrays."""

    arrays: dict[str, tuple[str, Header]]
    first: int
    rows: int
    number: int  # of the first row in the dataset


def shards(options: dict) -> list[dict[str, str]]:
    """Per shard the file of each array."""
    if "arrays" in options:
        return [json.loads(options["arrays"])]
    files, base = file_system(options["path"])
    listing = json.loads(read_file(files, f"{base}/{LISTING}"))
    return [{c: f"{options['path'].rstrip('/')}/{s}.{c}.npy" for c in listing["columns"]} for s in listing["shards"]]


class ArrayFiles(DataSource):
    """Columns are the arrays by name and ``row``, the number of a row; a narrower schema reads only the files it names."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        found = shards(dict(self.options))
        arrays = {c: read_header(p).spark_type for c, p in found[0].items()} if found else {}
        return T.StructType([T.StructField("row", T.LongType()), *[T.StructField(c, t) for c, t in arrays.items()]])

    def reader(self, schema: T.StructType) -> "ArrayReader":
        return ArrayReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> "ArrayWriter":
        return ArrayWriter(self.options["path"], schema, overwrite, int(self.options.get("split_bytes", SPLIT_BYTES)))


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[Range]:
        """Ranges of rows, the same in every array; arrays of different lengths are refused."""
        split, out, number = int(self.options.get("split_bytes", SPLIT_BYTES)), [], 0
        for paths in shards(self.options):
            headers = {c: read_header(p) for c, p in paths.items()}
            lengths = {c: h.shape[0] for c, h in headers.items()}
            if len(set(lengths.values())) != 1:
                raise ValueError(f"arrays of different lengths: {lengths}")
            total = next(iter(lengths.values()))
            step = max(1, split // max(1, *(h.row_bytes for h in headers.values())))
            wanted = {c: (paths[c], headers[c]) for c in self.schema.names if c in paths}
            missing = set(self.schema.names) - set(paths) - {"row"}
            if missing:
                raise ValueError(f"no array named {sorted(missing)}")
            out += [Range(wanted, at, min(step, total - at), number + at) for at in range(0, total, step)]
            number += total
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        opened = {}
        try:
            for name, (path, header) in part.arrays.items():
                files, inside = file_system(path)
                opened[name] = files.open_input_file(inside)
                opened[name].seek(header.start + part.first * header.row_bytes)
            step = max(1, BATCH_BYTES // max(1, *(h.row_bytes for _, h in part.arrays.values()), 8))
            for at in range(0, part.rows, step):
                n = min(step, part.rows - at)
                columns = []
                for field in self.schema.fields:
                    if field.name == "row":
                        columns.append(pa.array(np.arange(part.number + at, part.number + at + n, dtype=np.int64)))
                        continue
                    header = part.arrays[field.name][1]
                    values = np.frombuffer(opened[field.name].read(n * header.row_bytes), dtype=header.dtype)
                    columns.append(_column(values, header, n, field.dataType))
                yield pa.RecordBatch.from_arrays(columns, names=self.schema.names)
        finally:
            for f in opened.values():
                f.close()


def _column(values: np.ndarray, header: Header, n: int, kind: T.DataType) -> pa.Array:
    listed = isinstance(kind, T.ArrayType)
    if listed != (len(header.shape) > 1):
        raise ValueError(f"an array of shape {header.shape} is no {kind.simpleString()}")
    flat = pa.array(values.astype(NUMPY_TYPES[(kind.elementType if listed else kind).simpleString()], copy=False))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * header.row_values), flat) if listed else flat


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class ArrayWriter(DataSourceArrowWriter):
    """Every task writes whole shards under names of its own; the listing, replaced at the end, makes them part of the dataset.

    What a failed or repeated task wrote is in no listing.  Two writers at the
    same time are not for this: the later listing wins.
    """

    def __init__(self, path: str, schema: T.StructType, overwrite: bool, split_bytes: int):
        self.path, self.overwrite, self.split_bytes = path.rstrip("/"), overwrite, split_bytes
        self.types = {}
        for f in schema.fields:
            kind = (f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType).simpleString()
            if kind not in NUMPY_TYPES:
                raise ValueError(f"column {f.name} of type {f.dataType.simpleString()} is no array of numbers")
            self.types[f.name] = NUMPY_TYPES[kind]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, base = file_system(self.path)
        files.create_dir(base, recursive=True)
        done, held, size = [], {c: [] for c in self.types}, 0

        def flush():
            name = uuid.uuid4().hex
            for c, parts in held.items():
                write_file(files, f"{base}/{name}.{c}.npy", npy(np.concatenate(parts)))
                parts.clear()
            done.append(name)

        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, batch.num_rows * self.split_bytes // max(1, 4 * batch.nbytes))):
                piece = batch.slice(at, step)
                for c, kind in self.types.items():
                    held[c].append(_values(piece.column(c), c, kind))
                size += sum(x[-1].nbytes for x in held.values())
                if size >= self.split_bytes:
                    flush()
                    size = 0
        if any(held.values()):
            flush()
        return Written(done)

    def commit(self, messages: list[Written]) -> None:
        files, base = file_system(self.path)
        files.create_dir(base, recursive=True)
        before = []
        if not self.overwrite and files.get_file_info(f"{base}/{LISTING}").is_file:
            listing = json.loads(read_file(files, f"{base}/{LISTING}"))
            if listing["columns"] != list(self.types):
                raise ValueError(f"the dataset has the arrays {listing['columns']}, not {list(self.types)}")
            before = listing["shards"]
        names = [n for m in messages if m for n in m.names]
        part = f"{base}/{LISTING}.{uuid.uuid4().hex}"
        write_file(files, part, json.dumps({"columns": list(self.types), "shards": before + names}).encode())
        files.move(part, f"{base}/{LISTING}")

    def abort(self, messages: list[Written]) -> None:
        files, base = file_system(self.path)
        for message in messages:
            for name in message.names if message else ():
                for c in self.types:
                    files.delete_file(f"{base}/{name}.{c}.npy")


def _values(column: pa.Array, name: str, kind: str) -> np.ndarray:
    """A batch's column as rows of numbers; missing values and rows of different lengths have no place in an array file."""
    if not pa.types.is_list(column.type):
        if column.null_count:
            raise ValueError(f"column {name} has missing values")
        return column.to_numpy(zero_copy_only=False).astype(kind)
    lengths, flat = column.value_lengths().unique().to_pylist(), column.flatten()
    if len(lengths) != 1 or lengths[0] is None or flat.null_count:
        raise ValueError(f"column {name} has missing values or rows of different lengths")
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), lengths[0])


def read_array_files(spark: SparkSession, path: str | None = None, arrays: dict[str, str] | None = None, columns: list[str] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A dataset folder, or named array files, as ``row`` and one column per array.

    A task reads some ``split_bytes`` of the widest array, so one big file is
    many tasks.  With ``columns`` no file of another array is opened beyond
    its header.
    """
    spark.dataSource.register(ArrayFiles)
    reader = spark.read.format(FORMAT).option("split_bytes", split_bytes)
    reader = reader.option("arrays", json.dumps(arrays)) if arrays else reader.option("path", path)
    if columns is None:
        return reader.load()
    whole = reader.load().schema
    return reader.schema(T.StructType([whole[c] for c in columns])).load()


def write_array_files(df: DataFrame, path: str, mode: str = "append", split_bytes: int = SPLIT_BYTES) -> None:
    """Numeric and numeric-array columns as array files, some ``split_bytes`` a shard; a task holds one shard."""
    df.sparkSession.dataSource.register(ArrayFiles)
    df.write.format(FORMAT).option("split_bytes", split_bytes).mode(mode).option("path", path).save()
