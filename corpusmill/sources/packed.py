"""Packed token files as a Python Data Source: flat ids in ``.bin``, offsets in ``.idx``.

An index file holds the magic, a version (8 bytes), a code for the id type (1 byte), the number of lists n and n + 1 (8 bytes
each), then sizes (32 bits), byte pointers and document numbers 0 .. n (64 bits).  Every task writes a pair of its own, which
``join`` makes one; all are little-endian.  The folder must be one that all executors share.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

# Fixed values of the format.
MAGIC, VERSION, CODES = b"MMIDIDX\x00\x00", 1, {"uint16": 1, "uint32": 4, "int32": 5}


def index_bytes(sizes: np.ndarray, dtype: str = "uint32") -> bytes:
    n, width = len(sizes), np.dtype(dtype).itemsize
    pointers = np.concatenate([[0], np.cumsum(sizes.astype(np.int64) * width)[:-1]]) if n else np.zeros(0)
    head = MAGIC + struct.pack("<QBQQ", VERSION, CODES[dtype], n, n + 1)
    return head + sizes.astype("<i4").tobytes() + pointers.astype("<i8").tobytes() + np.arange(n + 1, dtype="<i8").tobytes()


def checked(ids: np.ndarray, dtype: str) -> np.ndarray:
    """Ids in the file's type; one that does not fit is an error."""
    bounds = np.iinfo(dtype)
    if len(ids) and (ids.min() < bounds.min or ids.max() > bounds.max):
        raise ValueError(f"ids {ids.min()} to {ids.max()} do not fit {dtype}")
    return ids.astype(dtype)


def read_header(data: bytes) -> tuple[int, str]:
    """Number of lists and id type; ValueError for any other file."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not an index file")
    version, code, n, closing = struct.unpack_from("<QBQQ", data, len(MAGIC))
    names = {v: k for k, v in CODES.items()}
    if version != VERSION or code not in names or closing != n + 1:
        raise ValueError("unknown index header")
    return n, names[code]


def read_index(data: bytes) -> tuple[str, np.ndarray, np.ndarray]:
    """Id type, sizes and byte pointers."""
    n, dtype = read_header(data)
    at = len(MAGIC) + 25
    if len(data) != at + 4 * n + 8 * n + 8 * (n + 1):
        raise ValueError("index file of a wrong length")
    return dtype, np.frombuffer(data, "<i4", n, at), np.frombuffer(data, "<i8", n, at + 4 * n)


@dataclass
class _Pair(InputPartition):
    stem: str


@dataclass
class _Written(WriterCommitMessage):
    stem: str
    lists: int


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, dtype: str, overwrite: bool):
        self.path, self.dtype = path, dtype
        os.makedirs(path, exist_ok=True)
        if not overwrite and any(f.endswith(".idx") for f in os.listdir(path)):
            raise ValueError(f"{path} is not empty")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        stem = os.path.join(self.path, f"part-{task.partitionId():05d}-{task.taskAttemptId()}")
        sizes = []
        with open(f"{stem}.bin.tmp", "wb") as out:
            for batch in iterator:
                lists = batch.column("tokens")
                out.write(checked(np.asarray(lists.flatten()), self.dtype).tobytes())
                sizes.append(np.asarray(lists.value_lengths().fill_null(0)))
        sizes = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
        with open(f"{stem}.idx.tmp", "wb") as out:
            out.write(index_bytes(sizes[sizes > 0], self.dtype))
        return _Written(stem, int((sizes > 0).sum()))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for end in ("bin", "idx"):
                os.replace(f"{m.stem}.{end}.tmp", f"{m.stem}.{end}")  # type: ignore[union-attr]

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for end in ("bin", "idx"):
                if m is not None and os.path.exists(f"{m.stem}.{end}.tmp"):  # type: ignore[attr-defined]
                    os.remove(f"{m.stem}.{end}.tmp")  # type: ignore[attr-defined]


class PackedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [_Pair(os.path.join(self.path, f[:-4])) for f in sorted(os.listdir(self.path)) if f.endswith(".idx")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        stem = partition.stem  # type: ignore[attr-defined]
        with open(f"{stem}.idx", "rb") as f:
            dtype, sizes, pointers = read_index(f.read())
        ids = np.memmap(f"{stem}.bin", dtype, "r") if len(sizes) else np.zeros(0, dtype)
        for a in range(0, len(sizes), 4096):
            some, width = sizes[a : a + 4096], ids.itemsize
            flat = np.asarray(ids[pointers[a] // width : pointers[a] // width + int(some.sum())]).astype(np.int64)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(some)]).astype(np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array([os.path.basename(stem)] * len(some)), pa.array(np.arange(a, a + len(some))), lists], ["part", "doc_idx", "tokens"])


class PackedTokens(DataSource):
    """Format ``packed_tokens``: write frames with a column ``tokens``, read part, doc_idx and tokens.  Empty lists are left out."""

    @classmethod
    def name(cls) -> str:
        return "packed_tokens"

    def schema(self) -> str:
        return "part string, doc_idx long, tokens array<long>"

    def _path(self) -> str:
        return self.options["path"].removeprefix("file://")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PackedReader(self._path())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PackedWriter(self._path(), self.options.get("dtype", "uint32"), overwrite)


#: Bytes that a task of ``join`` copies, and holds at a time.
SPAN, CHUNK = 256 << 20, 4 << 20
_PLAN = "stem string, dtype string, first long, lists long, at long, size long"


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for stem in batch.column("stem").to_pylist():
            with open(f"{stem}.idx", "rb") as f:
                n, dtype = read_header(f.read(len(MAGIC) + 25))
            rows.append({"stem": stem, "dtype": dtype, "lists": n, "size": os.path.getsize(f"{stem}.bin")})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("stem", pa.string()), ("dtype", pa.string()), ("lists", pa.int64()), ("size", pa.int64())]))


def join(spark: SparkSession, path: str, out: str) -> int:
    """Joins the pairs under ``path`` to the one pair ``out.bin``, ``out.idx``, in the order of their names; returns the lists in it.

    The pairs' places come from prefix sums over their headers, and every task writes its bytes of data, sizes, pointers and
    document numbers to their place, so no task or driver holds more than ``CHUNK``, and one that runs again writes the same.
    The pair appears under its names once all of it is written.
    """
    path, out = path.removeprefix("file://"), out.removeprefix("file://")
    stems = [os.path.join(path, f[:-4]) for f in sorted(os.listdir(path)) if f.endswith(".idx")]
    parts = spark.createDataFrame([(s,) for s in stems], "stem string").repartition(max(1, min(len(stems), 1000))).mapInArrow(_headers, "stem string, dtype string, lists long, size long")
    kinds = [r.dtype for r in parts.select("dtype").distinct().limit(2).collect()]
    if len(kinds) != 1:
        raise ValueError(f"pairs of one id type are needed, not of {kinds}")
    before = Window.orderBy("stem").rowsBetween(Window.unboundedPreceding, -1)  # one row per pair
    plan = parts.withColumns({"first": F.coalesce(F.sum("lists").over(before), F.lit(0)), "at": F.coalesce(F.sum("size").over(before), F.lit(0))})
    plan = spark.createDataFrame(plan.select(*[c.split()[0] for c in _PLAN.split(", ")]).toArrow(), _PLAN)
    total = plan.agg(F.sum("lists")).first()[0]
    head = len(MAGIC) + 25
    for end, data in (("bin", b""), ("idx", MAGIC + struct.pack("<QBQQ", VERSION, CODES[kinds[0]], total, total + 1))):
        with open(f"{out}.{end}.tmp", "wb") as f:
            f.write(data)
    with open(f"{out}.idx.tmp", "r+b") as f:
        f.seek(head + 12 * total + 8 * total)
        f.write(struct.pack("<q", total))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                begin, n = row["begin"], row["lists"]
                with open(f"{row['stem']}.bin", "rb") as source, open(f"{out}.bin.tmp", "r+b") as f:
                    source.seek(begin)
                    f.seek(row["at"] + begin)
                    left = min(SPAN, row["size"] - begin)
                    while left and (data := source.read(min(CHUNK, left))):
                        f.write(data)
                        left -= len(data)
                if begin:
                    continue
                with open(f"{row['stem']}.idx", "rb") as source, open(f"{out}.idx.tmp", "r+b") as f:
                    for a in range(0, n, CHUNK // 8):
                        some = min(CHUNK // 8, n - a)
                        source.seek(head + 4 * a)
                        f.seek(head + 4 * (row["first"] + a))
                        f.write(source.read(4 * some))
                        source.seek(head + 4 * n + 8 * a)
                        f.seek(head + 4 * total + 8 * (row["first"] + a))
                        f.write((np.frombuffer(source.read(8 * some), "<i8") + row["at"]).astype("<i8").tobytes())
                        f.seek(head + 12 * total + 8 * (row["first"] + a))
                        f.write(np.arange(row["first"] + a, row["first"] + a + some, dtype="<i8").tobytes())
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    spans = plan.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(SPAN).cast("long"))))
    spans.repartition(max(1, min(spans.count(), 10_000))).mapInArrow(copy, "n long").agg(F.sum("n")).collect()
    for end in ("bin", "idx"):
        os.replace(f"{out}.{end}.tmp", f"{out}.{end}")
    return int(total)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PackedTokens)
