"""Lines of growing files as a stream: format ``line_tail``, offsets are byte positions of each file.

Only whole lines are read: what stands after a file's last line end waits for its end, or until the file has not grown for
``idle`` seconds (option; never without it), when it counts as finished; that it then goes on in that line is an error, and so
is that it shrinks.  Positions lie in the stream's checkpoint, so a restart
goes on where the last batch ended.  The driver looks at sizes and at the bytes after the last line end, nothing else; tasks
read byte ranges of at most ``SPLIT``.  Folders and files whose names begin with _ or . are passed over.  The offset has an entry for each file, so the folder is one of live files, not an archive.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SPLIT, CHUNK = 64 << 20, 1 << 20


@dataclass
class Span(InputPartition):
    """The lines of a file that begin in [start, end), which are not followed beyond ``limit``; ``first`` if one begins at its start."""

    path: str
    start: int
    end: int
    limit: int
    first: bool


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def line_end(store: fs.FileSystem, path: str, size: int, least: int) -> int:
    """The place after the last line end before ``size``, ``least`` if there is none after that."""
    with store.open_input_file(path) as f:
        while size > least:
            start = max(least, size - CHUNK)
            f.seek(start)
            at = f.read(size - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            size = start
    return least


def lines(store: fs.FileSystem, span: Span, chunk: int = CHUNK) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that begin in the span, without their ends; the last may have none."""
    with store.open_input_file(span.path) as f:
        at = span.start if span.first else span.start - 1
        f.seek(at)
        skip, rest = not span.first, b""
        while data := f.read(min(chunk, span.limit - f.tell())):
            rest += data
            parts = rest.split(b"\n")
            rest = parts.pop()
            for part in parts:
                if at >= span.end:
                    return
                if not skip:
                    yield at, part
                at, skip = at + len(part) + 1, False
            if at >= span.end:
                return
        if rest and not skip and at < span.end:
            yield at, rest


class LineTailReader(DataSourceStreamReader):
    def __init__(self, path: str, idle: float | None):
        self.path, self.idle = path, idle
        self._ends: dict[str, tuple[int, int]] = {}  # size, and the place after its last line end

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, root = opened(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        now, out = time.time(), {}
        for info in found:
            if info.type != fs.FileType.File or any(p[:1] in ("_", ".") for p in info.path[len(root.rstrip("/")) :].strip("/").split("/")):
                continue
            size, end = self._ends.get(info.path, (-1, 0))
            if info.size != size:
                end = line_end(store, info.path, info.size, min(end, info.size))
                self._ends[info.path] = info.size, end
            # By the time of its last change, which a restart sees as well.
            quiet = self.idle is not None and info.mtime_ns is not None and now - info.mtime_ns / 1e9 >= self.idle
            out[info.path] = info.size if quiet else end
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out, store = [], opened(self.path)[0]
        for path, upto in sorted(end.items()):
            begin = start.get(path, 0)
            if upto != begin and begin:
                with store.open_input_file(path) as f:
                    f.seek(begin - 1)
                    if upto < begin or f.read(1) != b"\n":
                        raise ValueError(f"{path} has changed before byte {begin}, up to which it was read")
            out += [Span(path, a, min(a + SPLIT, upto), upto, a == begin) for a in range(begin, upto, SPLIT)]
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            ats, values = zip(*held, strict=True)
            text = [v.rstrip(b"\r").decode("utf-8", "replace") for v in values]
            return pa.record_batch([pa.array([partition.path] * len(ats)), pa.array(ats, pa.int64()), pa.array(text, pa.string())], names=["file", "at", "value"])

        for at, value in lines(opened(self.path)[0], partition):
            held.append((at, value))
            size += len(value) + 16
            if size > CHUNK:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    def commit(self, end: dict) -> None:
        """Nothing to do: files stay as they are."""


class LineTail(DataSource):
    """Format ``line_tail``: file, at (byte position) and value of every line."""

    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return "file string, at long, value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        idle = self.options.get("idle")
        return LineTailReader(self.options["path"], float(idle) if idle else None)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineTail)
