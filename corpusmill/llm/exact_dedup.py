"""Exact deduplication: counting quotient filters find repeated fingerprints, and only texts that have one are compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import quotient_filter
from corpusmill.llm.tables import grouped_rows, lean, small, stored

#: Distinct fingerprints that a task gathers before it writes its filters and begins anew.
HELD = 1 << 21
#: Fingerprints that one range of the merged filter is to hold.
RANGE = 1 << 20


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number that tells rows apart), fp, text_sha256 of every document, stored; null text is empty text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("fp"), F.sha2(text, 256).alias("text_sha256"))
    return stored(rows, "exact-fingerprints")


def filters(rows: DataFrame) -> DataFrame:
    """range, filter: one counting quotient filter of ``fp`` for each range of its upper bits.

    Every partition builds its own filters, which meet by range and are merged by their sorted remainders.  Fingerprints spread
    evenly over ranges and a hot one is a counter, so no range is large.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (max(4 * parts, rows.count() // RANGE) - 1).bit_length())
    width, schema = 64 - bits, "range int, filter binary"

    def emitted(ranges: list[int], data: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(ranges, pa.int32()), pa.array(data, pa.binary())], names=["range", "filter"])

    def cut(values: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        top = values >> np.uint64(width)
        starts = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(top) else np.zeros(0, int)
        rest = values & np.uint64((1 << width) - 1)
        for some in np.array_split(np.arange(len(starts)), -(-len(starts) // 256)) if len(starts) else []:
            bounds = [(starts[i], starts[i + 1] if i + 1 < len(starts) else len(values)) for i in some]
            yield emitted([int(top[a]) for a, _ in bounds], [quotient_filter.encode(rest[a:b], counts[a:b], width) for a, b in bounds])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(quotient_filter.counted(batch.column(0).to_numpy().view(np.uint64)))
            n += len(held[-1][0])
            if n > HELD:
                held = [quotient_filter.merged(held)]
                n = len(held[0][0])
                if 2 * n > HELD:
                    yield from cut(*held[0])
                    held, n = [], 0
        yield from cut(*quotient_filter.merged(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_rows(batches, "range"):
            values, counts = quotient_filter.merged([quotient_filter.decode(x.as_py()) for x in table.column("filter")])
            yield emitted([table.column("range")[0].as_py()], [quotient_filter.encode(values, counts, width)])

    local = rows.select("fp").mapInArrow(lean(build), schema)
    whole = local.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(lean(merge), schema)
    return stored(whole.withColumn("width", F.lit(width)), "exact-filters")


def repeated(whole: DataFrame) -> DataFrame:
    """fp of the fingerprints that the filters count more than once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top, data, width in zip(*(batch.column(c).to_pylist() for c in ("range", "filter", "width")), strict=True):
                values, counts = quotient_filter.decode(data)
                fp = values[counts > 1] | np.uint64(top << width)
                yield pa.record_batch([pa.array(fp.view(np.int64))], names=["fp"])

    return whole.mapInArrow(read, "fp long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document: of equal texts the row with the largest doc_id stays.

    Texts with a repeated fingerprint are grouped by their bytes, copies within a partition first; the others are not moved.
    Null text equals empty text.  A null doc_id is below all others.  Of repeated rows (one doc_id and text) one stays.  Other
    columns are not looked at.  An empty table gives no rows.
    """
    rows = fingerprints(docs)
    twice = small(stored(repeated(filters(rows)), "exact-repeated"))
    text = F.coalesce(F.col("text"), F.lit(""))
    routed = docs.select("doc_id", F.xxhash64(text).alias("fp"), text.alias("text")).join(twice, "fp", "left_semi")
    same = routed.groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    same = same.select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    # Which of its rows that is, if several have the id.
    stays = rows.join(twice, "fp", "left_semi").groupBy("fp", "text_sha256").agg(F.max(F.struct("doc_id", F.col("row").alias("stays"))).alias("m")).select("fp", "text_sha256", "m.stays")
    groups = small(stored(same.join(stays, ["fp", "text_sha256"]), "exact-groups"))
    out = rows.join(groups, ["fp", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("stays") == F.col("row"))).alias("kept"), "text_sha256",
    )
