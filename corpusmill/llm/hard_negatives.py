"""Hard-negative mining by distributed radix selection.

The k best rows of a window (an anchor, a range of scores, the same or another label) are found without sorting its rows: every
task counts its rows of the window by the leading digit of their distance from the window's top, the counts meet, the digit that
holds the k-th row is looked at by its next digit, and so on; equal scores are told apart by the digits of the id.  Once a prefix
holds few rows, only these are gathered.  A task reports a digit only if fewer than k of its own rows come before it, for the
k-th row of all lies no further.

Rows are dealt in groups that fit a task's memory, and the anchors, far fewer, go to every group: blocks of scores, no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.tables import lean, stored

POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score between which a negative's lies.
LOW, HIGH = 50, 95
#: Bits of a digit.
DIGIT = 8
#: Rows of a window that are gathered; more are counted by another digit.
GATHER = 64
#: Rows that a group has at least, for each adds its own counts.
GROUP_ROWS = 512
#: Bytes of vectors that a task holds, and scores at a time.
GROUP_BYTES, TILE = 1 << 26, 1 << 20

_WINDOW = "array<struct<w:int,top:long,low:long,shift:int,bits:int,prefix:long,tie:long,above:long,cut:long>>"
_EMPTY = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Pool:
    """The stored rows (row, vec_id, label, x, anchor) and what is known of them."""

    rows: DataFrame
    groups: int
    least_id: int
    id_bits: int
    kind: str  # of the numbers that hold every score exactly
    bound: int  # no score lies beyond it

    @property
    def anchors(self) -> DataFrame:
        return self.rows.filter("anchor")


def whole_steps(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """vec_id, label and x, the vector in whole steps of 1 / scale; rows with a null id, label or vector, no or null or non-finite entries go."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(vector) > 0) & ~bad)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("x"))


def pool(rows: DataFrame, is_anchor: str) -> Pool | None:
    """Rows (vec_id, label, x) stored, numbered, with the condition that makes an anchor; None without rows."""
    spark = rows.sparkSession
    own = stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "x", F.coalesce(F.expr(is_anchor), F.lit(False)).alias("anchor")), "mining-rows")
    norm = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    n, low, high, square, least, most = own.agg(F.count("*"), F.min("vec_id"), F.max("vec_id"), F.max(norm), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None
    if least != most:
        raise ValueError("the vectors have unlike lengths")
    bound = int(square * (1 + 1e-9)) + 1  # no sum of products, nor a part of it, is larger
    if bound >= 1 << 55:
        raise ValueError("the scores are beyond 55 bits")
    kind = "float32" if bound < 1 << 24 else "float64" if bound < 1 << 53 else "int64"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Pool(own, max(-(-n * most * 8 // GROUP_BYTES), min(2 * parts, -(-n // GROUP_ROWS))), low, (high - low).bit_length(), kind, bound)


def _opened(windows: DataFrame) -> DataFrame:
    """Windows (anchor, w, top, low) before the first digit; those without room go."""
    length = F.length(F.bin(F.col("top") - F.col("low"))).cast("int")
    none = F.lit(None).cast("long")
    rows = windows.filter("low <= top").withColumn("bits", F.least(length, F.lit(DIGIT)))
    return rows.withColumns({"shift": length - F.col("bits"), "prefix": F.lit(0).cast("long"), "tie": none, "above": F.lit(0).cast("long"), "cut": none})


def _struct() -> F.Column:
    return F.struct(*[F.col(part.split(":")[0]) for part in _WINDOW[len("array<struct<") : -2].split(",")])


def _scan(of: Pool, windows: DataFrame, same: bool, k: int, gather: bool) -> DataFrame:
    """Every window against the rows of its anchor's label, or of others: (anchor, w, above, digit, n), or the rows before the cut
    (anchor, w, score, vec_id)."""
    each = windows.groupBy("anchor").agg(F.collect_list(_struct()).alias("windows"))
    heads = of.anchors.withColumnRenamed("anchor", "_is").join(each, F.col("row") == F.col("anchor")).drop("_is", "anchor")
    heads = heads.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(of.groups - 1)))).withColumn("kind", F.lit(1))
    body = of.rows.drop("anchor").withColumns({"windows": F.lit(None).cast(_WINDOW), "grp": F.pmod(F.xxhash64("row"), F.lit(of.groups)).cast("int"), "kind": F.lit(0)})
    names = ["grp", "kind", "row", "vec_id", "label", "x", "windows"]
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = body.select(names).unionByName(heads.select(names)).repartition(parts, "grp").sortWithinPartitions("grp", "kind")
    least_id, number = of.least_id, np.dtype(of.kind)

    def vectors(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1).astype(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, built = [], None, None
        for batch in batches:
            grp, kind = batch.column("grp").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((grp[1:] != grp[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(grp)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if grp[a] != group:
                    held, group, built = [], grp[a], None
                if kind[a] == 0:
                    held.append((vectors(part), part.column("vec_id").to_numpy(), part.column("label").to_numpy()))
                    continue
                if held:
                    held, built = [], tuple(np.concatenate(x) for x in zip(*held, strict=True))
                for at in range(0, b - a if built else 0, 256):
                    some = part.slice(at, 256)
                    own = _Windows(some)
                    found = (_gathered if gather else _counted)(own, *_scores(own, vectors(some), some, built, same, least_id, gather), k)
                    if len(found[0]):
                        yield pa.record_batch(found, names=out)

    out = ["anchor", "w", "score", "vec_id"] if gather else ["anchor", "w", "above", "digit", "n"]
    return dealt.mapInArrow(lean(run), "anchor long, w int, score long, vec_id long" if gather else "anchor long, w int, above long, digit int, n long")


class _Windows:
    """The windows of a batch of anchors as matrices of (place in the anchor's list, anchor); low is above top where there is none."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        column, m = batch.column("windows"), batch.num_rows
        sizes = np.diff(column.offsets.to_numpy())
        flat, anchor = column.flatten(), np.repeat(np.arange(m), sizes)
        place = np.arange(len(anchor)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.n, self.ids = int(sizes.max(initial=0)), batch.column("row").to_numpy()
        for name, none in (("w", 0), ("top", -1), ("low", 0), ("shift", 0), ("bits", 0), ("prefix", 0), ("tie", -1), ("above", 0), ("cut", -1)):
            dense = np.full((self.n, m), none, np.int64)
            dense[place, anchor] = flat.field(name).fill_null(none).to_numpy()
            setattr(self, name, dense)


def _scores(own: _Windows, a: np.ndarray, batch: pa.RecordBatch, built: tuple, same: bool, least_id: int, gather: bool) -> tuple:
    """anchor, place, distance from the top, id's distance from the least id, score and id of the rows in the windows."""
    x, ids, labels = built
    low, none = own.low, own.low > own.top
    if gather:  # nothing beyond the cut
        reach = np.where(own.tie >= 0, own.tie, np.minimum(((own.cut + 1) << own.shift) - 1, own.top - own.low))
        low = np.maximum(low, own.top - reach)
    least = np.where(none, np.iinfo(np.int64).max, low).min(axis=0).astype(x.dtype)
    most = np.where(none, np.iinfo(np.int64).min, own.top).max(axis=0).astype(x.dtype)
    own_labels, own_ids = batch.column("label").to_numpy()[:, None], batch.column("vec_id").to_numpy()[:, None]
    parts = []
    for at in range(0, len(x), max(1, TILE // len(a))):
        tile = slice(at, at + max(1, TILE // len(a)))
        scores = a @ x[tile].T
        fits = (scores >= least[:, None]) & (scores <= most[:, None]) & ((labels[None, tile] == own_labels) == same) & (ids[None, tile] != own_ids)
        i, j = np.nonzero(fits)
        score, found = scores[i, j].astype(np.int64), ids[tile][j]
        for p in range(own.n):
            off = own.top[p, i] - score
            into = (off >= 0) & (score >= low[p, i])
            parts.append((i[into], np.full(into.sum(), p), off[into], score[into], found[into]))
    i, p, off, score, found = (np.concatenate(c) for c in zip(*parts, strict=True))
    return i, p, off.astype(np.uint64), found.astype(np.uint64) - np.uint64(least_id & ((1 << 64) - 1)), score, found


def _counted(own: _Windows, i: np.ndarray, p: np.ndarray, off: np.ndarray, back: np.ndarray, score: np.ndarray, found: np.ndarray, k: int) -> list[pa.Array]:
    tie, shift, bits = own.tie[p, i], own.shift[p, i].astype(np.uint64), own.bits[p, i].astype(np.uint64)
    value = np.where(tie >= 0, back, off) >> shift
    here = ((tie < 0) | (off == tie.astype(np.uint64))) & (value >> bits == own.prefix[p, i].astype(np.uint64))
    digit = (value & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    counts = np.zeros((own.n, len(own.ids), 1 << DIGIT), np.int64)
    np.add.at(counts, (p[here], i[here], digit[here]), 1)
    p, i, digit = np.nonzero((counts > 0) & (counts.cumsum(axis=2) - counts < (k - own.above)[:, :, None]))
    return [pa.array(own.ids[i]), pa.array(own.w[p, i], pa.int32()), pa.array(own.above[p, i]), pa.array(digit, pa.int32()), pa.array(counts[p, i, digit])]


def _gathered(own: _Windows, i: np.ndarray, p: np.ndarray, off: np.ndarray, back: np.ndarray, score: np.ndarray, found: np.ndarray, k: int) -> list[pa.Array]:
    tie, shift, cut = own.tie[p, i], own.shift[p, i].astype(np.uint64), own.cut[p, i].astype(np.uint64)
    level = off == tie.astype(np.uint64)
    here = np.where(tie < 0, off >> shift <= cut, (off < tie.astype(np.uint64)) | (level & (back >> shift <= cut)))
    i, p = i[here], p[here]
    return [pa.array(own.ids[i]), pa.array(own.w[p, i], pa.int32()), pa.array(score[here]), pa.array(found[here])]


def _refined(of: Pool, windows: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The windows after their open ones were counted by a digit."""
    upto = Window.partitionBy("anchor", "w").orderBy("digit")
    sums = counts.groupBy("anchor", "w", "above", "digit").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(upto))
    hit = sums.filter(F.col("above") + F.col("upto") >= k).groupBy(F.col("anchor").alias("_a"), F.col("w").alias("_w")).agg(F.min(F.struct("digit", "upto", "n")).alias("hit"))
    rows = windows.join(hit, (F.col("anchor") == F.col("_a")) & (F.col("w") == F.col("_w")), "left").drop("_a", "_w")
    rows = rows.withColumn("at", F.expr("shiftleft(prefix, bits) + hit.digit"))
    done = F.expr(f"above + hit.upto <= {GATHER} or (shift = 0 and tie is not null)")
    tied, still = F.expr("cut is null and shift = 0 and tie is null"), F.expr("cut is null and shift > 0")
    bits = min(of.id_bits, DIGIT)
    few, go_on = F.col("hit").isNull(), F.col("hit").isNotNull() & ~done
    cut = F.when(F.col("cut").isNotNull(), F.col("cut")).when(few, F.expr("shiftright(top - low, shift)")).when(done, F.col("at"))
    to_ids, deeper = go_on & tied, go_on & still
    return rows.select(
        "anchor", "w", "top", "low",
        F.when(to_ids, F.lit(bits)).when(deeper, F.least("shift", F.lit(DIGIT))).otherwise(F.col("bits")).cast("int").alias("bits"),
        F.when(to_ids, F.lit(of.id_bits - bits)).when(deeper, F.greatest(F.col("shift") - DIGIT, F.lit(0))).otherwise(F.col("shift")).cast("int").alias("shift"),
        F.when(to_ids, F.lit(0)).when(deeper, F.col("at")).otherwise(F.col("prefix")).cast("long").alias("prefix"),
        F.when(to_ids, F.col("at")).otherwise(F.col("tie")).alias("tie"),
        F.when(to_ids | deeper, F.expr("above + hit.upto - hit.n")).otherwise(F.col("above")).alias("above"),
        cut.alias("cut"),
    )


def best(of: Pool, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """anchor, w, place (from 1), score, vec_id of the k best rows of every window (anchor, w, top, low), by falling score, then id.

    The rows of an anchor's own id are none of its rows.  A row that is there several times counts as often.
    """
    known = stored(_opened(windows), "mining-windows")
    while (open_ := known.filter("cut is null")).limit(1).count():
        known = stored(_refined(of, known, _scan(of, open_, same, k, False), k), "mining-windows")
    found = _scan(of, known, same, k, True).groupBy("anchor", "w", "score", "vec_id").agg(F.count("*").alias("n"))
    each = found.withColumn("_n", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")))).drop("_n", "n")
    place = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id"))
    return stored(each.withColumn("place", place).filter(F.col("place") <= k), "mining-best")


def mined(rows: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, label, x of whole numbers).

    A score is the inner product with the anchor.  Of each anchor and each of its first ``positives`` other rows of its label, the
    first ``negatives`` rows of other labels between ``low`` and ``high`` percent of the positive's score; higher scores come first,
    ties by smaller id.  A positive with a score below 0 has none.  Rows of one id are one item: none is the other's positive, an
    anchor that is there several times gives its rows as often.  No rows, or no anchors, give none; vectors of unlike lengths, and
    scores beyond 55 bits, are errors.
    """
    of = pool(rows, is_anchor)
    if of is None:
        return rows.sparkSession.createDataFrame([], _EMPTY)
    whole = of.anchors.select(F.col("row").alias("anchor"), F.lit(0).alias("w"), F.lit(of.bound).cast("long").alias("top"), F.lit(-of.bound).cast("long").alias("low"))
    first = best(of, whole, True, positives).select("anchor", F.col("place").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = best(of, first.filter("positive_score >= 0").selectExpr("anchor", "w", f"positive_score * {high} div 100 as top", f"(positive_score * {low} + 99) div 100 as low"), False, negatives)
    near = near.select("anchor", "w", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = of.anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return near.join(first, ["anchor", "w"]).join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
