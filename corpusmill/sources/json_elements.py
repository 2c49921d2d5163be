"""The objects of an array in large JSON files, one object a file, by byte ranges.

Whether a range begins inside a string, and how deep, hangs on all bytes before it.  What a range does to both is known without
that: it turns the one over if it has an odd number of quotes that are not escaped, and adds one of two sums to the other.  So a
first pass over all ranges gives three numbers each, running sums over a file's ranges give every range's beginning, and a
second pass cuts out the objects that begin in each.  A file of any size is read by as many tasks as it has ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.sources.tables import scratch_path
from corpusmill.sources.tailing import opened

SPAN = 8 << 20
#: Bytes before an array's bracket in which its name and the colon have to stand.
NAME = 1 << 10
_SIGN = np.zeros(256, np.int8)
_SIGN[[ord("{"), ord("[")]], _SIGN[[ord("}"), ord("]")]] = 1, -1


def _read(store: fs.FileSystem, path: str, start: int, end: int) -> bytes:
    with store.open_input_file(path) as f:
        f.seek(max(start, 0))
        return f.read(max(end, 0) - max(start, 0))


def _slashes(store: fs.FileSystem, path: str, at: int) -> int:
    """How many backslashes stand right before a place."""
    n = 0
    while at > n:
        data = _read(store, path, at - n - NAME, at - n)
        run = len(data) - len(data.rstrip(b"\\"))
        n += run
        if run < len(data):
            break
    return n


def brackets(data: bytes, slashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of the brackets, their signs, the number of open or closing quotes before each, and that of all quotes."""
    own = np.frombuffer(data, np.uint8)
    plain = np.where(own != ord("\\"), np.arange(len(own)), -1 - slashes)  # the last byte that is no backslash, up to here
    plain = np.maximum.accumulate(plain) if len(plain) else plain
    quotes = np.flatnonzero(own == ord('"'))
    before = np.where(quotes > 0, plain[quotes - 1], -1 - slashes) if len(quotes) else quotes
    quotes = quotes[(quotes - 1 - before) % 2 == 0]
    at = np.flatnonzero(_SIGN[own])
    return at, _SIGN[own[at]].astype(np.int64), np.searchsorted(quotes, at), len(quotes)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            store, path = opened(row["file"])
            _, sign, quoted, n = brackets(_read(store, path, row["start"], row["end"]), _slashes(store, path, row["start"]))
            rows.append({**row, "turn": n % 2, "outside": int(sign[quoted % 2 == 0].sum()), "inside": int(sign[quoted % 2 == 1].sum())})
        kinds = [("file", pa.string()), *[(c, pa.int64()) for c in ("start", "end", "turn", "outside", "inside")]]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def _rest(store: fs.FileSystem, path: str, at: int, inside: int, deep: int, floor: int, step: int) -> bytes:
    """The bytes from a place on until the depth is back at ``floor``; to the end of a file that is cut off."""
    out, slashes = [], _slashes(store, path, at)
    while data := _read(store, path, at, at + step):
        places, sign, quoted, n = brackets(data, slashes)
        open_ = (quoted + inside) % 2 == 0
        closed = np.flatnonzero(deep + np.cumsum(sign[open_]) == floor)
        if len(closed):
            return b"".join([*out, data[: places[open_][closed[0]] + 1]])
        inside, deep, at = (inside + n) % 2, deep + int(sign[open_].sum()), at + len(data)
        run = len(data) - len(data.rstrip(b"\\"))
        slashes = run + (slashes if run == len(data) else 0)
        out.append(data)
    return b"".join(out)


def _cut(key: str, span: int):
    name = re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*$')

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = opened(row["file"])
                start, data = row["start"], _read(store, path, row["start"], row["end"])
                at, sign, quoted, n = brackets(data, _slashes(store, path, start))
                out = (quoted + row["within"]) % 2 == 0
                at, sign = at[out], sign[out]
                deep = row["deep"] + np.cumsum(sign)
                found: list[tuple[str, int, str | None]] = []
                for i in np.flatnonzero((deep == 2) & (sign == 1)).tolist():
                    if data[at[i] : at[i] + 1] == b"[" and name.search(_read(store, path, start + int(at[i]) - NAME, start + int(at[i]))):
                        found.append(("open", start + int(at[i]), None))
                found += [("close", start + int(at[i]), None) for i in np.flatnonzero((deep == 1) & (sign == -1)).tolist()]
                ends = np.append(np.flatnonzero((deep == 2) & (sign == -1)), len(at))
                for i in np.flatnonzero((deep == 3) & (sign == 1)).tolist():
                    if data[at[i]] != ord("{"):
                        continue
                    end = ends[np.searchsorted(ends, i)]
                    text = data[at[i] : at[end] + 1] if end < len(at) else data[at[i] :]
                    if end == len(at):
                        text += _rest(store, path, start + len(data), (row["within"] + n) % 2, int(deep[-1]), 2, span)
                    found.append(("element", start + int(at[i]), text.decode("utf-8", "replace")))
                kinds, places, values = zip(*found, strict=True) if found else ((), (), ())
                yield pa.record_batch([pa.array([row["file"]] * len(found), pa.string()), pa.array(kinds, pa.string()), pa.array(places, pa.int64()), pa.array(values, pa.string())], names=["file", "kind", "at", "value"])

    return run


def json_elements(spark: SparkSession, path: str, key: str, span: int | None = None) -> DataFrame:
    """file, at (byte) and value (JSON text) of the objects in the array ``key`` of the object that each file under ``path`` is.

    Elements that are no objects go, and so does an array of the name further down.  Of several arrays of the name at the top the
    elements of all are given.  A file that is cut off gives the elements up to there, the last as far as it goes.
    """
    span = span or SPAN
    store, root = opened(path)
    info = store.get_file_info(root)
    files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
    files = [f for f in files if f.type == fs.FileType.File and f.base_name[:1] not in ("_", ".")]
    prefix = path[: len(path) - len(root)] if path.endswith(root) else ""
    rows = [(prefix + f.path, a, min(a + span, f.size)) for f in files for a in range(0, f.size, span)]
    spans = spark.createDataFrame(rows, "file string, start long, end long")
    made = scratch_path(spark, "json-spans")
    spans.repartition(max(1, min(len(rows), 10_000))).mapInArrow(_effects, "file string, start long, end long, turn long, outside long, inside long").write.parquet(made)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each span
    begun = spark.read.parquet(made).withColumn("within", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    begun = begun.withColumn("deep", F.coalesce(F.sum(F.when(F.col("within") == 1, F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    cut = begun.select("file", "start", "end", "within", "deep").repartition(max(1, min(len(rows), 10_000))).mapInArrow(_cut(key, span), "file string, kind string, at long, value string")
    made = scratch_path(spark, "json-elements")
    cut.write.parquet(made)
    cut = spark.read.schema("file string, kind string, at long, value string").parquet(made)
    ends = cut.filter("kind = 'close'").select(F.col("file").alias("f"), F.col("at").alias("end"))
    arrays = cut.filter("kind = 'open'").select("file", F.col("at").alias("begin")).join(ends, (F.col("file") == F.col("f")) & (F.col("end") > F.col("begin")), "left")
    arrays = arrays.groupBy(F.col("file").alias("f"), "begin").agg(F.coalesce(F.min("end"), F.lit((1 << 63) - 1)).alias("end"))  # a row or a few for each file
    inside = (F.col("file") == F.col("f")) & (F.col("at") > F.col("begin")) & (F.col("at") < F.col("end"))
    return cut.filter("kind = 'element'").join(arrays, inside).select("file", "at", "value")
