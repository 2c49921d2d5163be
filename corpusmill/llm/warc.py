"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing goes through Spark's own text sink, so archives land by its commit protocol in any store it can write to.  The
sink ends each row with a separator; the one used here, ``SEPARATOR``, is itself an empty skippable frame, so every file
is a plain sequence of Zstandard frames that any decoder reads.  A file holds about ``ARCHIVE_BYTES`` of payload, so the
reader, which takes whole files, needs bounded memory.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page_id is a response, the
others are revisits of it without payload.  Defined cases: null html is an empty payload; a null page_id sorts last and
is read back as null; a null or empty url is written as ``urn:page:<id>``; rows tied on page_id are ordered by url, and
fully repeated rows get equal records of one type; an empty table gives archives without records; other columns are
ignored.  The reader raises ``ValueError`` on a broken frame, header, length or digest.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.tables import small, stored

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT = 100
#: The dictionary is trained on at most so many pages, of each at most so many bytes.
DICT_PAGES, DICT_PAGE_BYTES, DICT_BYTES = 256, 16 << 10, 64 << 10
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
# Fixed values of the Zstandard frame format and of WARC's use of it.
FRAME_MAGIC, SKIP_MAGIC, DICT_MAGIC = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, and refers_to and is_revisit."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    rank = F.struct(F.isnull("page_id").alias("none"), F.col("page_id").alias("id"), F.col("url").alias("url"))
    first = (
        rows.filter(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("payload_digest").alias("digest"), "first")
    )
    # Digests that occur once need no partner, so this table is mostly small; counted, it spares the payloads a shuffle.
    first = small(stored(first, "warc-firsts"))
    joined = rows.join(first, rows["payload_digest"] == first["digest"], "left")
    same = F.col("page_id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    return joined.withColumn("is_revisit", F.col("first").isNotNull() & ~same).select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", "is_revisit",
        F.when(F.col("is_revisit"), F.col("first.id")).alias("refers_to"),
    )


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample (``DICT_PAGES`` x ``DICT_PAGE_BYTES``), the pages with the least hashes of id and url, the
    same in every run; empty if there is too little text."""
    sample = pages.select(F.xxhash64("page_id", "url").alias("h"), F.substring(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 1, DICT_PAGE_BYTES).alias("b"))
    samples = [bytes(r.b) for r in sample.orderBy("h", "b").limit(DICT_PAGES).collect() if r.b]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def record_bytes(page_id, url, payload: bytes, digest: str, is_revisit: bool, refers_to) -> bytes:
    """One WARC record with its two closing line ends."""
    name = "null" if page_id is None else page_id
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{name}"
    block = HTTP % len(payload) + (b"" if is_revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"] if is_revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dict_data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=dict_data, write_checksum=True)
        if dictionary:
            head = struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary
            yield pa.RecordBatch.from_arrays([pa.array([head], pa.binary())], ["frame"])
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "is_revisit", "refers_to")]
            frames = [packer.compress(record_bytes(*(c[i].as_py() for c in columns))) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    return write


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes a record for each row of ``pages`` (page_id, url, html) to new archives under ``path``."""
    rows = with_roles(pages)
    size = pages.agg(F.sum(F.octet_length("html")).alias("n")).first().n or 0
    n = max(1, -(-size // ARCHIVE_BYTES))
    dealt = rows.repartition(n, F.xxhash64("page_id", "payload_digest") % (n * 64))
    frames = dealt.mapInArrow(_writer(train_dictionary(pages)), "frame binary")
    # Each file starts with the dictionary of its task, so a task writes one file, whatever the session's limit.
    frames.select(F.col("frame").cast("string")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).text(path)


def frames_of(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(magic, frame) of each frame; data frames are walked block by block to their end."""
    at, n = 0, len(data)
    while at < n:
        if at + 8 > n:
            raise ValueError(f"truncated frame at byte {at}")
        magic, length = struct.unpack_from("<II", data, at)
        if magic & ~0xF == SKIP_MAGIC:
            end = at + 8 + length
        elif magic == FRAME_MAGIC:
            end = at + zstandard.frame_header_size(bytes(data[at : at + 18]))
            last = False
            while not last:
                if end + 3 > n:
                    raise ValueError(f"truncated block at byte {end}")
                head = int.from_bytes(data[end : end + 3], "little")
                last, kind = head & 1, head >> 1 & 3
                if kind == 3:
                    raise ValueError(f"reserved block type at byte {end}")
                end += 3 + (1 if kind == 1 else head >> 3)
            end += 4 * (data[at + 4] >> 2 & 1)
        else:
            raise ValueError(f"unknown magic {magic:#x} at byte {at}")
        if end > n:
            raise ValueError(f"truncated frame at byte {at}")
        yield magic, data[at:end]
        at = end


def parse_record(raw: bytes) -> dict:
    """The record's fields, after checks of its version line, headers, lengths and digest."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines:
        key, colon, value = line.partition(b":")
        if not colon or not key.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        fields[key.strip().lower().decode()] = value.strip().decode()
    try:
        length, kind, name = int(fields["content-length"]), fields["warc-type"], fields["warc-record-id"]
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
    except KeyError as e:
        raise ValueError(f"missing header {e}") from e
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{name}: Content-Length {length} does not fit")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    if not gap or not stated or kind not in ("response", "revisit"):
        raise ValueError(f"{name}: no HTTP header or unknown type {kind}")
    if kind == "response" and (len(payload) != int(stated[1]) or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{name}: payload differs from its length or digest")
    number = lambda urn: None if urn.endswith(":null>") else int(urn.rpartition(":")[2][:-1])
    return {
        "page_id": number(name), "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": number(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_bytes": int(stated[1]), "payload_digest": digest, "payload": payload if kind == "response" else None,
    }


def archive_records(content: bytes) -> Iterator[dict]:
    """The records of one archive: the dictionary from its leading frame, then one record per data frame."""
    unpacker, first = zstandard.ZstdDecompressor(), True
    for magic, frame in frames_of(memoryview(content)):
        if first and magic == DICT_MAGIC:
            raw = bytes(frame[8:])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        elif magic == FRAME_MAGIC:
            yield parse_record(unpacker.decompressobj().decompress(bytes(frame)))
        first = False


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for record in archive_records(content.as_py()):
                rows.append(record)
                size += len(record["payload"] or b"")
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, with columns ``RECORDS``."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, RECORDS)
