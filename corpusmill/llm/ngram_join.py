"""N-gram Jaccard join: signature trees inside exact prefix blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z lower-cased; a document's set holds its distinct
``SHINGLE``-word shingles as 64-bit hashes (the whole sequence when it has fewer words).  Two sets link when
100 * intersection >= ``PERCENT`` * union.

1. ``shingle_sets``: one pass gives each document's set id (equal sets share one from here on), size and bitmap, and a
   bounded list of frequent shingles, which only orders the next step.
2. Any two linked sets share one of their first n - ceil(3 n / 4) + 1 shingles in any common order; frequent shingles
   come last in ours.  Sets with a common prefix shingle form a block; blocks with equal members are one.
3. In each block a signature tree (see ``signature_tree``) finds a spanning forest of the pairs whose bitmaps allow the
   bound; its components hold every link.
4. In each such component trees are walked again, now with exact intersections of the full sets.

Blocks and components of more than ``LIMIT`` sets are cut into chunks, and each pair of chunks is a task of its own, so
no task holds an unbounded group and nothing is dropped.

Defined cases: null and blank texts have an empty set, link with nothing, and are their own component; repeated rows
give a row each; a null doc_id never names a component (null if no document of it has an id); empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import graph
from corpusmill.llm.signature_tree import Block, bitmap
from corpusmill.llm.tables import grouped_rows, lean, small, stored, unused
from corpusmill.llm.text_arrays import span_hashes, splitmix, text_chunks, window_hashes, words

SHINGLE, PERCENT = 5, 75
LIMIT = 4096
#: Frequent shingles: at most so many, found by counting within runs of so many shingles of every task.
FREQUENT, FREQUENT_RUN, FREQUENT_LEAST = 1 << 16, 1 << 21, 4
#: Prefix shingles a reducing task holds, about.
TASK_KEYS = 1_500_000


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for _, _, data, offsets in text_chunks(column):
        starts, ends, row = words(data, offsets)
        hashes = span_hashes(data, starts, ends)
        runs = window_hashes(hashes, SHINGLE)
        bounds = np.searchsorted(row, np.arange(len(offsets)))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                yield splitmix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield runs[:0]


def _set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), len(s))).astype(np.int64))


_PASS = pa.schema([("doc_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("frequent", pa.int64()), ("seen", pa.int64())])


def _shingle_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, held_n = [], 0

    def frequent() -> pa.RecordBatch:
        keys, seen = np.unique(np.concatenate(held), return_counts=True)
        often = seen >= FREQUENT_LEAST
        none = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.nulls(len(none), pa.binary()), pa.array(keys[often].view(np.int64)), pa.array(seen[often])], schema=_PASS)

    for batch in batches:
        sids, sizes, maps = [], [], []
        for s in sets_of(batch.column("text")):
            sids.append(_set_id(s))
            sizes.append(len(s))
            maps.append(bitmap(s) if len(s) else None)
            held.append(s)
            held_n += len(s)
            if held_n >= FREQUENT_RUN:
                yield frequent()
                held, held_n = [], 0
        none = pa.nulls(len(sids), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary()), none, none], schema=_PASS)
    if held:
        yield frequent()


def shingle_sets(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """(doc_id, sid, n, bits) per row, stored, and the frequent shingles."""
    both = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_shingle_pass), "doc_id long, sid long, n long, bits binary, frequent long, seen long"), "ngram-sets")
    often = both.filter("frequent is not null").groupBy("frequent").agg(F.sum("seen").alias("seen"))
    top = often.orderBy(F.desc("seen"), "frequent").limit(FREQUENT).select("frequent").collect()
    return both.filter("sid is not null").select("doc_id", "sid", "n", "bits"), [r.frequent for r in top]


def _prefixes(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            keys, sids, sizes = [], [], []
            for s in sets_of(batch.column("text")):
                if not len(s) or (sid := _set_id(s)) in done:
                    continue
                done.add(sid)
                take = len(s) - (3 * len(s) + 3) // 4 + 1
                late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s if len(frequent) else np.zeros(len(s), bool)
                first = s[~late][:take]
                keys.append(first if len(first) == take else np.concatenate([first, s[late][: take - len(first)]]))
                sids.append(sid)
                sizes.append(len(s))
            if keys:
                n = [len(k) for k in keys]
                arrays = [np.concatenate(keys).view(np.int64), np.repeat(np.array(sids, np.int64), n), np.repeat(np.array(sizes, np.int64), n)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["key", "sid", "n"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each key that at least two sets share and whose sizes fit with another's; equal member lists share a block id."""
    parts = [[batch.column(c).to_numpy() for c in ("key", "sid", "n")] for batch in batches]
    if not parts:
        return
    key, sid, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((sid, n, key))
    key, sid, n = key[order], sid[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
    key, sid, n = key[new], sid[new], n[new]
    # In size order, a member whose two neighbours are both out of range has no partner, and the list splits there.
    near = (key[1:] == key[:-1]) & (4 * n[:-1] >= 3 * n[1:])
    starts = np.flatnonzero(np.append(True, ~near))
    ends = np.append(starts[1:], len(key))
    many = ends - starts > 1
    seen: set[int] = set()
    out_block, out_at = [], []
    for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
        block = xxhash.xxh3_64_intdigest(np.sort(sid[a:b]).tobytes())
        if block not in seen:
            seen.add(block)
            out_block.append(np.full(b - a, block, np.uint64))
            out_at.append(np.arange(a, b))
    if out_at:
        at = np.concatenate(out_at)
        for i in range(0, len(at), 1 << 18):
            cut = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_block)[i : i + (1 << 18)].view(np.int64)), pa.array(sid[cut])], ["block", "sid"])


def _dealt(members: DataFrame) -> DataFrame:
    """Members (block, sid, ...) with ``task``: their block, or one row for each pair of chunks that theirs is in."""
    size = members.groupBy(F.col("block").alias("_b")).count().filter(F.col("count") > LIMIT)
    chunks = members.join(size, F.col("block") == F.col("_b"), "left")
    chunks = chunks.withColumn("_k", F.expr(f"cast(coalesce(ceil(count / {LIMIT}), 1) as int)")).withColumn("_c", F.expr("pmod(xxhash64(sid), _k)"))
    pairs = F.expr("transform(sequence(0, _k - 1), j -> if(_k = 1, block, xxhash64(block, least(_c, j), greatest(_c, j))))")
    return chunks.withColumn("task", F.explode(pairs)).drop("_b", "count", "_k", "_c")


def _forest(exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for rows in grouped_rows(batches, "task"):
            sid, n, bits = rows.column("sid").to_numpy(), rows.column("n").to_numpy(), rows.column("bits").to_pylist()
            check = None
            if exact:
                sets = rows.column("hashes")
                of = lambda i: np.frombuffer(sets[i].as_buffer(), np.uint64)  # noqa: B023, E731

                def check(i: int, j: int) -> bool:
                    both = len(np.intersect1d(of(i), of(j), assume_unique=True))
                    return 100 * both >= PERCENT * (n[i] + n[j] - both)

            for i, j in Block(n, bits, PERCENT).join(check):
                left.append(sid[i])
                right.append(sid[j])
            if len(left) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(sets_of(batch.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set", "hashes"])


def _tasks(members: DataFrame, exact: bool) -> DataFrame:
    dealt = _dealt(members)
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "task").sortWithinPartitions("task").mapInArrow(lean(_forest(exact)), "a long, b long")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, sid (set id), root (least sid of the component), n_shingles, component_id for each row of ``docs``."""
    spark = docs.sparkSession
    sets, frequent = shingle_sets(docs)
    total = sets.agg(F.sum("n").alias("n")).first().n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (4 * TASK_KEYS) + 1)
    text = docs.select(F.col("doc_id").cast("long"), "text")
    hot = np.sort(np.array(frequent, np.int64).view(np.uint64))
    keys = text.select("text").mapInArrow(lean(_prefixes(hot)), "key long, sid long, n long")
    blocks = keys.repartition(parts, "key").mapInArrow(lean(_blocks), "block long, sid long").distinct()
    one = sets.filter("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("doc_id").alias("least"))
    members = stored(blocks.join(one.drop("least"), "sid"), "ngram-blocks")
    near = stored(graph.components(_tasks(members, False), "ngram-near"), "ngram-near")
    # The full sets of the sets that have a possible partner, from one document each.
    wanted = stored(near.join(one, F.col("node") == F.col("sid")).select("root", "sid", "n", "bits", "least"), "ngram-wanted")
    ids = small(wanted.select(F.col("least").alias("_i")).distinct())
    full = text.join(ids, F.col("doc_id").eqNullSafe(F.col("_i")), "left_semi").select("text").mapInArrow(lean(_with_sets), "set long, hashes binary")
    full = full.groupBy("set").agg(F.first("hashes").alias("hashes"))
    exact = wanted.join(full, F.col("sid") == F.col("set")).select(F.col("root").alias("block"), "sid", "n", "bits", "hashes")
    linked = stored(graph.components(_tasks(exact, True), "ngram-links"), "ngram-links")
    named = linked.join(one.select("sid", "least"), F.col("node") == F.col("sid")).groupBy("root").agg(F.min("least").alias("name"))
    groups = linked.join(named, "root").select("node", "root", "name")
    own = one.select(F.col("sid").alias("_s"), "least")
    rows = sets.select("doc_id", "sid", "n").join(own, F.col("sid") == F.col("_s"), "left").join(groups, F.col("sid") == F.col("node"), "left")
    return rows.select("doc_id", "sid", F.coalesce("root", "sid").alias("root"), F.col("n").alias("n_shingles"), F.coalesce("name", "least", "doc_id").alias("component_id"))


def _tagged(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = pa.array([_set_id(s) for s in sets_of(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), sids], [*columns, "_sid"])

    return run


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that link, in any number of steps, to one that stays.

    Of each component the document with the least doc_id stays (one without an id only if none has one); documents
    without words all stay.  Of repeated rows one stays.
    """
    found = stored(components(docs), "ngram-components")
    order = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("sid").alias("sid"))
    first = found.filter("n_shingles > 0").groupBy("root").agg(F.min(order).alias("f")).select("f.id", "f.sid")
    copies = found.groupBy("doc_id", "sid").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    stay = copies.join(first, copies["doc_id"].eqNullSafe(first["id"]) & (copies["sid"] == first["sid"]), "left_semi")
    stay = stay.unionByName(copies.filter("n = 0")).select(F.col("doc_id").alias("_i"), F.col("sid").alias("_s"), F.when(F.col("n") > 0, F.col("copies")).otherwise(1).alias("_copies"))
    i = unused(docs, "_i")
    stay = stored(stay.withColumnRenamed("_i", i), "ngram-survivors")
    here = F.col("doc_id").cast("long").eqNullSafe(F.col(i))
    if not found.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count():
        return docs.join(small(stay.select(i)), here, "left_semi")
    # Ids are missing or repeated: rows are told apart by their set id, and repeated rows by a row number.
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_doc"))
    tagged = whole.mapInArrow(lean(_tagged(whole.columns)), T.StructType([*whole.schema.fields, T.StructField("_sid", T.LongType())]))
    kept = tagged.join(stay, here & (F.col("_sid") == F.col("_s")))
    if stay.filter("_copies > 1").limit(1).count():
        rank = F.row_number().over(Window.partitionBy("doc_id", "_sid").orderBy("text"))
        kept = kept.withColumn("_rank", rank).filter("_copies = 1 or _rank = 1")
    return kept.select("_doc.*")
