"""Suffix-array dedup: bytes covered by a ``WIDTH``-byte string that also starts at another place of the corpus.

1. Equal texts, told by 128 bits of hash, count as one from here on, so a text that a third of the documents share is one
   text; one with copies is a repeat as a whole.
2. Every window of WIDTH bytes has an anchor, the leftmost of its ``ANCHOR``-byte strings with the least hash.  Equal windows have equal
   anchors, so the windows of one anchor (a *piece*: neighbouring starts, with the bytes they cover) meet in one shard.
   Pieces whose anchor occurs once hold no repeat and go no further.
3. Equal pieces of a shard become one string with a weight.  An anchor with one such string has nothing left to sort:
   the weight says that all its windows repeat.
4. The strings of the other anchors are sorted by external induced suffix sorting (``induced_sort``); a start whose
   common prefix with a neighbour reaches WIDTH repeats.
5. Repeated starts go back to the documents, are joined to maximal runs, and the bytes are removed.

Defined cases: null text counts as empty; texts shorter than WIDTH bytes lose nothing; texts of any length are cut whole;
repeated rows are copies of each other and each gets a row; doc_ids of any integer type, null too, are kept; an empty table
gives an empty result; other columns are ignored by ``removed_spans`` and kept by ``cleaned``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.induced_sort import repeated_starts
from corpusmill.llm.tables import lean, small, stored
from corpusmill.llm.text_arrays import byte_window_hashes, sliding_minimum, text_chunks

WIDTH = 200
ANCHOR = 64
#: Bytes of text a sorting task gets, about.
SHARD_BYTES = 8 << 20


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text, as ``text_key`` and ``other_key``."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole).alias("text_key"), F.xxhash64(F.lit(1), whole).alias("other_key")


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of texts that the task has not met before."""
    done: set[tuple[int, int]] = set()
    for batch in batches:
        keys = list(zip(batch.column("text_key").to_pylist(), batch.column("other_key").to_pylist(), strict=True))
        new = []
        for i, key in enumerate(keys):
            if key not in done:
                done.add(key)
                new.append(i)
        yield batch if len(new) == len(keys) else batch.take(pa.array(new, pa.int64()))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _fresh(batches):
        others, keys = batch.column("other_key").to_numpy(), batch.column("text_key").to_numpy()
        for first, _, data, offsets in text_chunks(batch.column("text")):
            hashes = byte_window_hashes(data, ANCHOR) if len(data) >= WIDTH else np.zeros(0, np.uint64)
            # The leftmost of the least hashes by their upper halves: equal windows choose it at equal offsets.
            ranked = hashes >> np.uint64(32) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
            least = (sliding_minimum(ranked, WIDTH - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            # Windows that lie in one document, and where a new document or the place of another anchor begins.
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
            inside = offsets[doc + 1] - np.arange(len(least)) >= WIDTH
            cut = np.ones(len(least), bool)
            cut[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(least))
            keep = inside[starts] if len(starts) else np.zeros(0, bool)
            starts, ends = starts[keep], ends[keep]
            view = memoryview(data)
            same = [xxhash.xxh3_64_intdigest(view[a : b + WIDTH - 1], b - a) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            row = doc[starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(others[row + first]), pa.array(keys[row + first]), pa.array(hashes[least[starts]].view(np.int64)),
                    pa.array(np.array(same, np.uint64).view(np.int64)), pa.array((starts - offsets[row]).astype(np.int64)), pa.array((ends - starts).astype(np.int32)),
                ],
                ["other_key", "text_key", "anchor", "piece", "start", "n"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _fresh(batches):
        out: list[tuple] = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
            data = (text.as_py() or "").encode()
            out += [(w["anchor"], w["piece"], w["weight"], data[w["start"] : w["start"] + w["n"] + WIDTH - 1]) for w in wanted.as_py()]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["anchor", "piece", "weight", "bytes"])


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated runs of starts of each string of a shard; windows beyond a piece's own are too short to count."""
    rows = [[batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "piece", "weight", "bytes")] for batch in batches]
    if not rows:
        return
    anchor, piece, weight, strings = (np.concatenate(c) for c in zip(*rows, strict=True))
    at, low, high = [], [], []
    for i, hit in enumerate(repeated_starts(strings.tolist(), WIDTH)):
        if weight[i] > 1:
            hit[: len(hit) - WIDTH + 1] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).view(np.int8)))
        low.append(edge[::2])
        high.append(edge[1::2])
        at.append(np.full(len(edge) // 2, i))
    i = np.concatenate(at)
    yield pa.RecordBatch.from_arrays([pa.array(anchor[i]), pa.array(piece[i]), pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], ["anchor", "piece", "low", "high"])


def copied_texts(docs: DataFrame) -> DataFrame:
    """text_key, other_key of the texts of WIDTH bytes or more that several documents have."""
    keys = docs.filter(F.octet_length("text") >= WIDTH).select(*text_keys(F.col("text")))
    return stored(keys.groupBy("text_key", "other_key").count().filter("count > 1").drop("count"), "suffix-copies")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """text_key, other_key and ``runs``, an array of (low, high) ranges of starts of windows that repeat elsewhere in the distinct
    texts, for texts that have any."""
    spark = docs.sparkSession
    texts = docs.filter(F.octet_length("text") >= WIDTH).select("text", *text_keys(F.col("text")))
    columns = "other_key long, text_key long, anchor long, piece long, start long, n int"
    least = spark.conf.get("spark.sql.shuffle.partitions")
    shared = (
        texts.mapInArrow(lean(_pieces), columns).repartition(int(least), "anchor")
        .selectExpr("*", "count(*) over (partition by anchor) as total", "min(piece) over (partition by anchor) as p0", "max(piece) over (partition by anchor) as p1")
        .filter("total > 1")
    )
    shared = stored(shared.selectExpr("other_key", "text_key", "anchor", "piece", "start", "n", "p0 <> p1 as differ"), "suffix-pieces")
    # Each distinct string once, from the text with the least key that has it.
    place = F.struct("other_key", "text_key", "start")
    strings = shared.filter("differ").groupBy("anchor", "piece").agg(F.count("*").alias("weight"), F.min(place).alias("at"), F.first("n").alias("n"))
    wanted = strings.groupBy(F.col("at.other_key").alias("_o"), F.col("at.text_key").alias("_t")).agg(
        F.collect_list(F.struct("anchor", "piece", "weight", F.col("at.start").alias("start"), "n")).alias("wanted"), F.sum(F.col("n") + WIDTH).alias("size")
    )
    wanted = stored(wanted, "suffix-wanted")
    ids = small(wanted.select(F.col("_o").alias("_j"), F.col("_t").alias("_u")))
    near = texts.join(ids, (F.col("other_key") == F.col("_j")) & (F.col("text_key") == F.col("_u")), "left_semi")
    cut = near.join(wanted, (F.col("other_key") == F.col("_o")) & (F.col("text_key") == F.col("_t"))).select("text", "text_key", "other_key", "wanted")
    size = wanted.agg(F.sum("size").alias("n")).first().n or 0
    shards = max(int(least), -(-size // SHARD_BYTES))
    cut = cut.mapInArrow(lean(_cut), "anchor long, piece long, weight long, bytes binary").groupBy("anchor", "piece").agg(F.first("weight").alias("weight"), F.first("bytes").alias("bytes"))
    found = cut.repartition(shards, "anchor").mapInArrow(lean(_sort), "anchor long, piece long, low long, high long")
    keys = ["text_key", "other_key"]
    whole = shared.filter("not differ").select(*keys, "start", (F.col("start") + F.col("n")).alias("end"))
    part = shared.filter("differ").join(found, ["anchor", "piece"]).select(*keys, (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("end"))
    return whole.unionByName(part).groupBy(*keys).agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def _with_runs(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and text of ``docs``, with the runs of repeated starts of its text; all starts of a text with copies.

    Rows of texts with copies, be they many, take no part in the join with runs: they are spread by their number instead.
    """
    runs = repeated_windows(docs).withColumnsRenamed({"text_key": "_t", "other_key": "_o"})
    copied = small(copied_texts(docs).withColumnsRenamed({"text_key": "_ct", "other_key": "_co"}))
    rows = docs.select(*keep, *text_keys(F.col("text"))).join(copied, (F.col("text_key") == F.col("_ct")) & (F.col("other_key") == F.col("_co")), "left")
    single = F.col("_ct").isNull()
    rows = rows.withColumns({"_k": F.when(single, F.col("text_key")).otherwise(F.monotonically_increasing_id()), "_l": F.when(single, F.col("other_key"))})
    both = rows.join(runs, (F.col("_k") == F.col("_t")) & (F.col("_l") == F.col("_o")), "left")
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.octet_length("text") - (WIDTH - 1)).cast("long").alias("end")))
    return both.select(*keep, F.when(~single, every).otherwise(F.col("runs")).alias("runs"))


def covered(runs: list[dict]) -> list[list[int]]:
    """Maximal byte runs covered by the windows that start in ``runs``."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], r["end"]) for r in runs):
        b += WIDTH - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[], [], [], [], [], []]
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            data = (text.as_py() or "").encode()
            spans = covered(runs.as_py() or [])
            kept = b"".join(data[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(data)], strict=True))
            for column, value in zip(columns, (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore")), strict=True):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string(), pa.binary(), pa.string())
        names = ["n_bytes", "n_removed", "spans", "kept_sha256", "kept", "kept_text"]
        extra = [(n, batch.column(n)) for n in batch.schema.names if n not in ("text", "runs")]
        yield pa.RecordBatch.from_arrays([*(c for _, c in extra), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], [*(n for n, _ in extra), *names])


def removed_spans(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed [begin, end) runs), kept_sha256 per row, and ``kept`` bytes if asked."""
    both = _with_runs(docs.select("doc_id", "text"), ["doc_id", "text"])
    kind = both.schema["doc_id"].dataType.simpleString()
    out = both.mapInArrow(lean(_remove), f"doc_id {kind}, {_REMOVED}")
    out = out.drop("kept_text")
    return out if with_bytes else out.drop("kept")


_REMOVED = "n_bytes long, n_removed long, spans array<array<long>>, kept_sha256 string, kept binary, kept_text string"


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated bytes cut out of ``text`` and ``n_chars`` counted anew where it
    exists; a character cut in two goes, and so does a document of which nothing is left.  Unchanged rows stay as they are."""
    both = _with_runs(docs.select("text", F.struct(*docs.columns).alias("_doc")), ["_doc", "text"])
    schema = T.StructType([both.schema["_doc"], *T._parse_datatype_string(_REMOVED).fields])
    cut = both.mapInArrow(lean(_remove), schema).filter("n_removed = 0 or n_removed < n_bytes")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("_doc.text"))
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_doc.n_chars")) if "n_chars" in docs.columns else None}
    return cut.withColumn("_text", text).select(*[(new[c] if new.get(c) is not None else F.col("_doc").getField(c)).alias(c) for c in docs.columns])
