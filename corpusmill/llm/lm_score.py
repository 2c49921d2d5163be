"""Language-model scoring with an order-3 n-gram model whose trie levels are Elias-Fano coded.

Lower-case A-Z; a text's tokens are its words ``[^\\x20\\x09-\\x0D]+`` and one end.  With c for counts over the training
documents, N for all training tokens and V for the distinct ones,

    P1(w) = (c(w) + 1) / (N + V + 1),  P(w | h) = (c(h w) + MU * P(w | shorter h)) / (c(h) + MU)

for the one and two words before (two begin marks stand before a text).  ``base_score`` sums log10 P1, ``score`` sums
log10 P(w | two words before) as quantised in the trie.

1. Texts are packed into chunks of about ``CHUNK_BYTES`` as numbers of their distinct words, stored once as a table bucketed
   by chunk, so that no later step moves them.
2. Level by level (words, pairs, triples) every chunk sends its distinct n-grams, each with its training count in the chunk,
   to shards by ranges of their hashes: sorted, split by byte planes and compressed, one row for each shard that it has
   any for.  A word that makes up a third of all rows is still one entry of each chunk.
3. A shard adds the counts and answers each chunk in the order it asked, with a mark on what other chunks have too.  An
   n-gram with a part that no other chunk has is no other chunk's either: its own count is the whole one, and it is not
   sent.  This is exact, and most pairs and triples of a varied corpus are such.
4. A chunk builds the trie of its n-grams that occur in training (``elias_fano``) and scores its texts with it.

Memory is bounded by a chunk (or by the longest single text) and by ``SHARD_KEYS``.  Defined cases: null and blank texts
have the end as only token; texts of any length are scored whole; a null doc_id counts as the text '' for crc32, so it is
training; repeated rows are scored one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.elias_fano import Trie
from corpusmill.llm.tables import bucketed, grouped_rows, lean, stored
from corpusmill.llm.text_arrays import span_hashes, text_chunks, window_hashes, words

#: Weight of the shorter history in P(w | h), for one and for two words before.
MU = (1000.0, 3.0)
CHUNK_BYTES = 4 << 20
#: N-grams that a shard gets from all chunks, at most about.
SHARD_KEYS = 2_000_000
BEGIN, END = np.uint64(0x8C3F9A5D12B7E461), np.uint64(0xD1B54A32D192ED03)
_TEXTS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("size", pa.int64())])


def in_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def _squeezed(values: np.ndarray) -> bytes:
    """Byte planes of whole numbers, compressed: the upper planes of sorted or small values hold long runs."""
    width = values.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def _restored(data: bytes, n: int, kind: type = np.uint64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, n).T).view(kind).ravel()


def _sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text's after two begin marks, and the number of each text's tokens and marks."""
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in text_chunks(column):
        starts, ends, row = words(data, offsets)
        n = len(offsets) - 1
        out = np.full(len(row) + 3 * n, BEGIN, np.uint64)
        count = np.bincount(row, minlength=n)
        out[np.arange(len(row)) + 3 * row + 2] = span_hashes(data, starts, ends)
        out[np.cumsum(count + 3) - 1] = END
        parts.append(out)
        sizes.append(count + 3)
    return np.concatenate(parts), np.concatenate(sizes)


PACKED = "chunk long, n long, train long, docs binary, words binary, n_words long, seq binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def chunk() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        seq, sizes = _sequence(table.column("text").combine_chunks())
        known, index = np.unique(seq, return_inverse=True)
        docs = pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), table.column("held_out").combine_chunks(), pa.array(sizes)], schema=_DOCS)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(docs)
        training = ~np.asarray(docs.column("held_out").to_numpy(zero_copy_only=False), bool)
        columns = [
            pa.array([uuid.uuid4().int >> 65]), pa.array([int((sizes - 2).sum())]), pa.array([int((sizes - 2)[training].sum())]),
            pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([_squeezed(known)], pa.binary()), pa.array([len(known)]),
            pa.array([_squeezed(index.astype(np.uint32))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "n", "train", "docs", "words", "n_words", "seq"])

    for batch in batches:
        batch = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())], schema=_TEXTS)
        for a, b, data, _ in text_chunks(batch.column("text")):
            held.append(batch.slice(a, b - a))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield chunk()
                held, size = [], 0
    if held:
        yield chunk()


class Chunk:
    """The texts of a chunk: ``words`` (their sorted hashes), ``seq`` (number of the word at each place) and where each text begins."""

    def __init__(self, row: dict):
        docs = pa.ipc.open_stream(row["docs"]).read_all().combine_chunks()
        self.doc_id, self.held_out = docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks()
        sizes = docs.column("size").to_numpy()
        n = int(sizes.sum())
        self.words = _restored(row["words"], row["n_words"])
        self.seq = _restored(row["seq"], n, np.uint32).astype(np.int64)
        self.n_docs, self.text = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
        self.depth = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.training = (~np.asarray(self.held_out.to_numpy(zero_copy_only=False), bool))[self.text]

    def count_words(self) -> None:
        """n1: training occurrences of each word; of the begin mark, training texts."""
        self.n1 = np.bincount(self.seq, self.training & (self.depth > 0), len(self.words)).astype(np.int64)

    def count_pairs(self) -> None:
        """left, right, n2 of the distinct pairs by (left, right), and the pair that ends at each place."""
        w, at = len(self.words), np.flatnonzero(self.depth > 0)
        pairs, index = np.unique(self.seq[at - 1] * w + self.seq[at], return_inverse=True)
        self.left, self.right = pairs // w, pairs % w
        self.n2 = np.bincount(index, self.training[at], len(pairs)).astype(np.int64)
        self.pair = np.zeros(len(self.seq), np.int64)
        self.pair[at] = index

    def count_triples(self) -> None:
        """head, tail (their two pairs), n3 of the distinct triples, and the triple that ends at each token."""
        w = len(self.words)
        self.token = np.flatnonzero(self.depth > 1)
        triples, first, self.triple = np.unique(self.pair[self.token - 1] * w + self.seq[self.token], return_index=True, return_inverse=True)
        self.head, self.tail = triples // w, self.pair[self.token[first]]
        self.n3 = np.bincount(self.triple, self.training[self.token], len(triples)).astype(np.int64)

    def asked(self, level: int, answers: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the n-grams of a level that other chunks may have, and the number of each among the chunk's."""
        if level == 0:
            return self.words, np.arange(len(self.words))
        if level == 1:
            shared = (answers[0] & 1).astype(bool)
            at = np.flatnonzero(shared[self.left] & shared[self.right])
            key = _joined(self.words[self.left[at]], self.words[self.right[at]])
        else:
            shared = np.zeros(len(self.n2), bool)
            shared[self.asked(1, answers)[1]] = answers[1] & 1
            at = np.flatnonzero(shared[self.head] & shared[self.tail])
            key = _joined(self.words[self.left[self.head[at]]], self.words[self.right[self.head[at]]], self.words[self.right[self.tail[at]]])
        order = np.argsort(key)
        return key[order], at[order]

    def whole(self, level: int, answers: list[np.ndarray | None]) -> np.ndarray:
        """Training count in all chunks of each n-gram of a level."""
        out = (self.n1, self.n2, self.n3)[level].copy()
        out[self.asked(level, answers)[1]] = answers[level] >> 1
        return out


def _joined(*parts: np.ndarray) -> np.ndarray:
    """A hash of each n-gram, given the hashes of its words."""
    return window_hashes(np.stack(parts, axis=1).ravel(), len(parts))[:: len(parts)]


def _answers(chunk: Chunk, row: dict, levels: int) -> list[np.ndarray | None]:
    """What the shards answered at each of the first levels, in the order asked; also brings the chunk's counts up to the next level."""
    out: list[np.ndarray | None] = []
    for level in range(levels + 1):
        if level < 3:
            (chunk.count_words, chunk.count_pairs, chunk.count_triples)[level]()
        if level < levels:
            parts = sorted(row[f"a{level}"] or [], key=lambda r: r["shard"])
            out.append(np.concatenate([*(_restored(p["counts"], p["n"]).view(np.int64) for p in parts), np.zeros(0, np.int64)]))
    return out


def _ask(level: int, shard_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                answers = _answers(chunk, row, level)
                keys, at = chunk.asked(level, answers)
                counts = (chunk.n1, chunk.n2 if level else None, chunk.n3 if level > 1 else None)[level][at]
                bounds = np.searchsorted(keys, np.arange(1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits)) if shard_bits else np.zeros(1, np.int64)
                bounds = np.append(bounds, len(keys))
                rows = [(s, row["chunk"], b - a, _squeezed(keys[a:b]), _squeezed(counts[a:b])) for s, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)) if b > a]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["shard", "chunk", "n", "keys", "counts"])

    return run


def _answer(level: int):
    """Adds a shard's counts up; an answer is twice the count, and one more where several chunks asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped_rows(batches, "shard"):
            sizes = rows.column("n").to_pylist()
            unpack = lambda c: np.concatenate([_restored(x.as_py(), n) for x, n in zip(rows.column(c), sizes, strict=True)])  # noqa: B023, E731
            keys, index = np.unique(unpack("keys"), return_inverse=True)
            total = np.bincount(index, unpack("counts").view(np.int64), len(keys)).astype(np.int64)
            types = int(np.count_nonzero(total[keys != BEGIN])) if level == 0 else 0
            total = total << 1 | (np.bincount(index, minlength=len(keys)) > 1)
            bounds = np.cumsum([0, *sizes])
            values = [_squeezed(total[index[a:b]]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            first = np.zeros(len(sizes), np.int64)
            first[0] = types
            yield pa.RecordBatch.from_arrays([rows.column("chunk").combine_chunks(), rows.column("shard").combine_chunks(), pa.array(sizes), pa.array(values, pa.binary()), pa.array(first)], ["chunk", "shard", "n", "counts", "types"])

    return run


def chunk_scores(chunk: Chunk, c1: np.ndarray, c2: np.ndarray, c3: np.ndarray, train_tokens: int, types: int) -> pa.RecordBatch:
    """The scores of a chunk's texts, given the training count of each of its words, pairs and triples."""
    back = lambda c, mu: np.log10(mu / (c + mu))
    left, right, head, tail = chunk.left, chunk.right, chunk.head, chunk.tail
    p1 = (c1 + 1) / (train_tokens + types + 1)
    log_p1 = np.log10(p1)
    # The trie holds what occurs in training; a triple that does has both its pairs there.
    p2 = (c2 + MU[0] * p1[right]) / (c1[left] + MU[0])
    two, three = np.flatnonzero(c2 > 0), np.flatnonzero(c3 > 0)
    number = np.zeros(len(c2), np.int64)
    number[two] = np.arange(len(two))
    p3 = (c3[three] + MU[1] * p2[tail[three]]) / (c2[head[three]] + MU[1])
    trie = Trie(
        {"prob": log_p1, "back": back(c1, MU[0])},
        {"first": left[two], "second": right[two], "prob": np.log10(p2[two]), "back": back(c2[two], MU[1])},
        {"head": number[head[three]], "tail": number[tail[three]], "prob": np.log10(p3)},
    )
    each = trie.score_pairs(left, right, head, tail)
    token, n = chunk.token, chunk.n_docs
    text, own = chunk.text[token], chunk.seq[token]
    sums = lambda values: np.bincount(text, values, n)
    columns = [
        chunk.doc_id, chunk.held_out, pa.array(np.bincount(text, minlength=n)), pa.array(sums(c1[own] > 0).astype(np.int64)),
        pa.array(np.full(n, train_tokens)), pa.array(sums(log_p1[own])), pa.array(sums(each[chunk.triple])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _scored(train_tokens: int, types: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                answers = _answers(chunk, row, 3)
                yield chunk_scores(chunk, *(chunk.whole(k, answers) for k in range(3)), train_tokens, types)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """One row (``SCORES``) for each row of ``docs``; documents where ``held_out`` is true teach the model nothing."""
    spark = docs.sparkSession
    held_out = in_held_out(F.col("doc_id")) if held_out is None else held_out
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    packed = bucketed(texts.mapInArrow(lean(_packed), PACKED), "lm-chunks", "chunk", max(least, size // CHUNK_BYTES))
    sums = packed.agg(F.sum("n").alias("n"), F.sum("train").alias("train")).first()
    shard_bits = max(2, -(-(sums.n or 0) // SHARD_KEYS) - 1).bit_length()
    state, types = packed, 0
    for level in range(3):
        asked = state.mapInArrow(lean(_ask(level, shard_bits)), "shard long, chunk long, n long, keys binary, counts binary")
        dealt = asked.repartition(max(least, 1 << shard_bits), "shard").sortWithinPartitions("shard")
        answers = dealt.mapInArrow(lean(_answer(level)), "chunk long, shard long, n long, counts binary, types long")
        if level < 2:  # later levels ask for these again
            answers = stored(answers, f"lm-answers-{level}")
        if level == 0:
            types = answers.agg(F.sum("types").alias("v")).first().v or 0
        # A chunk's answers are bounded by the chunk.
        each = answers.groupBy(F.col("chunk").alias("_c")).agg(F.collect_list(F.struct("shard", "n", "counts")).alias(f"a{level}"))
        state = state.join(each, F.col("chunk") == F.col("_c"), "left").drop("_c")
    return state.mapInArrow(lean(_scored(sums.train or 0, types)), SCORES)
