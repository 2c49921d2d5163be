"""Quality classifier: an interpolated modified Kneser-Ney model over byte n-grams, trained on trusted text.

1. Order-``ORDER`` byte n-grams of the trusted documents are counted: each task adds up its own, Spark joins the shards.
   The trusted documents are all those labelled ``quality = 1``, each with its whole text.
2. Continuation counts of the lower orders, discounts, context weights and smoothed probabilities are joins and
   aggregations of count tables, all in Spark.  Byte n-grams saturate: the tables grow ever slower with the text.
3. The finished tables are cut into shards by the last two bytes of the context, so that every byte of a text is scored
   whole by one shard.  Each holds at most ``SHARD_GRAMS`` n-grams (counted), and goes to the tasks by broadcast; every
   shard scans the texts once, and a document's sums are added up.
4. ``loss`` is the mean negative log10 probability of a byte, ``perplexity`` is 10 ** loss.  A document is kept when its
   loss is at most its language's median + ``FENCE`` * (third quartile - median, at least ``LEAST_SPREAD``), by mergeable
   sketches over all documents, + ``NOISE`` / sqrt(bytes), for the mean of a short text varies more.

Defined cases: null and empty texts have no loss and are not kept; null lang is a language of its own; without trusted
text every byte costs log10(256); repeated rows are judged one by one; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import small, stored
from corpusmill.llm.text_arrays import text_chunks

ORDER = 5
SHARD_GRAMS = 6_000_000
QUANTILES = (0.5, 0.75)
FENCE, LEAST_SPREAD, NOISE = 4.0, 0.01, 0.5
#: Windows counted at a time, and distinct ones that a task holds before it hands them on.
RUN, HELD = 1 << 22, 1 << 22


def _windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ORDER bytes up to each byte of each text as a number; zeros stand before a text."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    depth = np.arange(len(data)) - offsets[row]
    out = np.zeros(len(data), np.int64)
    for back in range(ORDER - 1, -1, -1):
        out <<= 8
        out[back:] |= np.where(depth[back:] >= back, data[: len(data) - back], 0) if back else data
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, sums, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        fresh, n = np.unique(np.concatenate(held), return_counts=True) if held else (keys[:0], sums[:0])
        out, index = np.unique(np.concatenate([keys, fresh]), return_inverse=True)
        return out, np.bincount(index, np.concatenate([sums, n]), len(out)).astype(np.int64)

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column("text")):
            held.append(_windows(data, offsets))
            size += len(data)
            if size >= RUN:
                (keys, sums), held, size = merged(), [], 0
                if len(keys) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["code", "c"])
                    keys, sums = keys[:0], sums[:0]
    keys, sums = merged()
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["code", "c"])


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of all documents labelled good."""
    good = small(stored(labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct(), "kn-good"))
    return docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_id"), "left_semi").select("text")


def _suffix(code: Column, order: int) -> Column:
    return code.bitwiseAND(F.lit((1 << 8 * order) - 1))


def model(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k, code, p) of every seen n-gram of order k, and (k, code, w) of every context of order k: the log10 of its weight."""
    top = stored(texts.mapInArrow(_count, "code long, c long").groupBy("code").agg(F.sum("c").alias("c")), "kn-counts")
    levels, level = [top.select(F.lit(ORDER).alias("k"), "code", "c")], top
    for k in range(ORDER - 1, 0, -1):
        level = level.groupBy(_suffix(F.col("code"), k).alias("code")).agg(F.count("*").alias("c"))
        levels.append(level.select(F.lit(k).alias("k"), "code", "c"))
    counts = levels[0]
    for x in levels[1:]:
        counts = counts.unionByName(x)
    counts = stored(counts, "kn-levels")
    often = [F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    discounts = {r.k: _discounts(r.n1, r.n2, r.n3, r.n4) for r in counts.groupBy("k").agg(*often).collect()}
    cut = F.lit(0.0)
    for k, d in discounts.items():
        cut = F.when(F.col("k") == k, F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).otherwise(cut)
    counts = counts.withColumn("cut", cut).withColumn("ctx", F.shiftright("code", 8))
    contexts = counts.groupBy("k", "ctx").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("w"))
    contexts = stored(contexts, "kn-contexts")
    seen = counts.join(contexts, ["k", "ctx"]).select("k", "code", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own"), "w")
    seen = stored(seen, "kn-own")
    done = seen.filter("k = 1").select("code", (F.col("own") + F.col("w") / 256).alias("p"))
    parts = [done.select(F.lit(1).alias("k"), "code", "p")]
    for k in range(2, ORDER + 1):
        lower = done.select(F.col("code").alias("_c"), F.col("p").alias("_p"))
        here = seen.filter(F.col("k") == k)
        done = stored(here.join(lower, _suffix(F.col("code"), k - 1) == F.col("_c")).select("code", (F.col("own") + F.col("w") * F.col("_p")).alias("p")), f"kn-{k}")
        parts.append(done.select(F.lit(k).alias("k"), "code", "p"))
    grams = parts[0]
    for x in parts[1:]:
        grams = grams.unionByName(x)
    return grams.withColumn("p", F.log10("p").cast("float")), contexts.select("k", F.col("ctx").alias("code"), F.log10("w").cast("float").alias("w"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, by the closed form; where it has no value in range, a half, one and one and a half."""
    usual = (0.5, 1.0, 1.5)
    if not (n1 and n2 and n3):
        return usual
    y = n1 / (n1 + 2 * n2)
    own = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < i else u for i, (d, u) in enumerate(zip(own, usual, strict=True), 1))  # type: ignore[return-value]


class Shard:
    """The n-grams and contexts whose last two context bytes fall in one shard; shorter ones are in every shard."""

    def __init__(self, grams: pa.Table, contexts: pa.Table, shard: int, shards: int):
        self.shard, self.shards = shard, shards
        self.grams, self.contexts = ([self._level(t, c, k) for k in range(1, ORDER + 1)] for t, c in ((grams, "p"), (contexts, "w")))

    @staticmethod
    def _level(table: pa.Table, column: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.asarray(table.column("k")) == k
        code, value = np.asarray(table.column("code"))[own], np.asarray(table.column(column))[own]
        order = np.argsort(code)
        return code[order], value[order]

    @staticmethod
    def _find(level: tuple[np.ndarray, np.ndarray], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = level
        if not len(keys):
            return np.zeros(len(code), bool), np.zeros(len(code), np.float32)
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        return keys[at] == code, values[at]

    def score(self, code: np.ndarray) -> np.ndarray:
        """log10 P of the last byte of each window."""
        out, at = np.zeros(len(code)), np.arange(len(code))
        for k in range(ORDER, 0, -1):
            part = code[at] & ((1 << 8 * k) - 1)
            hit, p = self._find(self.grams[k - 1], part)
            out[at[hit]] += p[hit]
            at, part = at[~hit], part[~hit]
            known, w = self._find(self.contexts[k - 1], part >> 8)
            out[at[known]] += w[known]
        out[at] -= np.log10(256)
        return out

    def own(self, code: np.ndarray) -> np.ndarray:
        return shard_of(code >> 8 & 0xFFFF, self.shards) == self.shard


def shard_of(pair, shards: int):
    """The shard of the last two context bytes; of numbers or of a column."""
    return pair * 40503 % 65536 % shards


def _score(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = broadcast.value
        for batch in batches:
            sums, sizes = [], []
            for _, _, data, offsets in text_chunks(batch.column("text")):
                code = _windows(data, offsets)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                if shard.shards > 1:
                    own = shard.own(code)
                    code, row = code[own], row[own]
                distinct, index = np.unique(code, return_inverse=True)
                sums.append(np.bincount(row, shard.score(distinct)[index], len(offsets) - 1))
                sizes.append(np.diff(offsets))
            zero = [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "lang", "key")), pa.array(np.concatenate([*sizes, *zero]).astype(np.int64)), pa.array(np.concatenate([*sums, *zero]))], ["doc_id", "lang", "key", "n_bytes", "log10_p"])

    return run


def losses(docs: DataFrame, grams: DataFrame, contexts: DataFrame, shard_grams: int = 0) -> DataFrame:
    """doc_id, lang, n_bytes, loss of each row of ``docs``."""
    spark, most = docs.sparkSession, shard_grams or SHARD_GRAMS
    texts = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    pairs = grams.filter("k > 2").groupBy(F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF)).alias("pair")).count()
    pairs, shards = {r.pair: r["count"] for r in pairs.collect()}, 1  # at most 65,536 rows
    while shards < 65536 and max(np.bincount([shard_of(p, shards) for p in pairs], list(pairs.values()), shards), default=0) > most:
        shards *= 2
    parts = []
    for shard in range(shards):
        tables = []
        for frame, short, last in ((grams, 2, F.shiftright("code", 8)), (contexts, 2, F.col("code"))):
            pair = last.bitwiseAND(F.lit(0xFFFF))
            tables.append(frame.filter((F.col("k") <= short) | (shard_of(pair, shards) == shard)).toArrow())
        made = spark.sparkContext.broadcast(Shard(*tables, shard, shards))
        part = texts.mapInArrow(_score(made), "doc_id long, lang string, key long, n_bytes long, log10_p double")
        parts.append(part.withColumn("shard", F.lit(shard)))
    loss = F.when(F.col("n_bytes") > 0, -F.col("log10_p") / F.col("n_bytes")).alias("loss")
    if shards == 1:
        return parts[0].select("doc_id", "lang", "n_bytes", loss)
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionByName(x)
    key = ["doc_id", "lang", "key", "n_bytes"]
    each = whole.groupBy(*key, "shard").agg(F.first("log10_p").alias("log10_p"), F.count("*").alias("copies"))
    sums = each.groupBy(*key).agg(F.sum("log10_p").alias("log10_p"), F.max("copies").alias("copies"))
    return sums.select("doc_id", "lang", "n_bytes", loss, F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("col")


def judged(scored: DataFrame) -> DataFrame:
    """``scored`` with ``perplexity``, ``high`` (the language's bound of the loss) and ``kept``."""
    at = F.percentile_approx("loss", list(QUANTILES), 10_000).alias("q")
    middle, upper = F.col("q")[0], F.col("q")[1]
    bounds = scored.groupBy(F.col("lang").alias("_lang")).agg(at)
    bounds = bounds.select("_lang", (middle + FENCE * F.greatest(upper - middle, F.lit(LEAST_SPREAD))).alias("high"))
    out = scored.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    kept = F.col("loss") <= F.col("high") + NOISE / F.sqrt("n_bytes")
    return out.withColumns({"perplexity": F.pow(F.lit(10.0), F.col("loss")), "kept": F.coalesce(kept, F.lit(False))})


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_bytes, loss, high, perplexity, kept of each row of ``docs``."""
    grams, contexts = model(trusted(docs, labels))
    grams, contexts = stored(grams, "kn-grams"), stored(contexts, "kn-weights")
    return judged(stored(losses(docs, grams, contexts), "kn-losses"))
