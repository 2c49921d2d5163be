"""Operators over sequences, vectors and index lists, as joins, windows and aggregations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrays import ahead, dequantised, dot, quantised, sigmoid
from corpusmill.operators.scans import last_value, scanned, stored
from corpusmill.operators.selection import order_statistics


def shifted(tokens: DataFrame, depths: int, fill: int = 0, ignore: int = -1) -> DataFrame:
    """doc_id, pos, depth, token, target of (doc_id, tokens): the token ``depth`` places on and the one after it."""
    own = F.col("tokens")
    each = [F.struct(F.lit(k).alias("depth"), F.arrays_zip(ahead(own, k, fill).alias("token"), ahead(own, k + 1, ignore).alias("target")).alias("pairs")) for k in range(1, depths + 1)]
    rows = tokens.select("doc_id", F.explode(F.array(*each)).alias("d")).select("doc_id", "d.depth", F.posexplode("d.pairs").alias("pos", "p"))
    return rows.select("doc_id", "pos", "depth", "p.token", "p.target")


def within_bounds(scores: DataFrame, bounds: DataFrame | None) -> DataFrame:
    """The scores (row, pos, ..) at the positions in [start, end) of their row's bounds (row, start, end); all without bounds."""
    if bounds is None:
        return scores
    ends = bounds.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    return scores.join(ends, (F.col("row") == F.col("_row")) & (F.col("pos") >= F.col("_start")) & (F.col("pos") < F.col("_end"))).drop("_row", "_start", "_end")


def top_k(scores: DataFrame, k: int, bounds: DataFrame | None = None) -> DataFrame:
    """The k best (row, pos, score) of each row, ties by position, with their rank from 1; with ``bounds`` (row, start, end) of the
    positions in [start, end) only, and rows without bounds give none.

    Spark limits the groups before the exchange: each task passes on k rows of a row, so a row of any length is spread over tasks.
    """
    scores = within_bounds(scores, bounds)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "pos"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def selected_top_k(scores: DataFrame, k: int, bounds: DataFrame | None = None) -> DataFrame:
    """As ``top_k``, without sorting a row: its k-th greatest score comes from counts by parts of the range (``order_statistics``),
    one pass takes what lies above it, and of the rows tied with it the first ones are taken by position.

    For rows of any length, in any number of tasks; nulls and NaN are no scores.
    """
    known = within_bounds(scores, bounds).filter("score is not null and not isnan(score)")
    limits = order_statistics(known, ["row"], "score", {"least": f"greatest(n - {k} + 1, 1)"}).select(F.col("row").alias("_row"), F.col("least").alias("_least"))
    near = known.join(limits, F.col("row").eqNullSafe(F.col("_row")) & (F.col("score") >= F.col("_least")))
    level = F.row_number().over(Window.partitionBy("row").orderBy("pos"))
    ties = near.filter("score = _least").withColumn("_at", level).filter(F.col("_at") <= k).drop("_at")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "pos"))  # of fewer than 2 k rows
    return near.filter("score > _least").unionByName(ties).drop("_row", "_least").withColumn("rank", rank).filter(F.col("rank") <= k)


def overlap(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """row, common of two index lists (row, idx), and whether both have k entries; the mean share comes by ``mean_overlap``."""
    both = a.join(b.select("row", F.col("idx").alias("_b")), "row")
    return both.select("row", F.size(F.array_intersect("idx", "_b")).alias("common"), F.lit(k).alias("k"), ((F.size("idx") == k) & (F.size("_b") == k)).alias("same_shape"))


def mean_overlap(rows: DataFrame) -> DataFrame:
    """The mean share in percent; NaN where a row's lists have other lengths than k (``same_shape`` false)."""
    fits = F.bool_and("same_shape") if "same_shape" in rows.columns else F.lit(True)
    return rows.agg(F.when(fits, F.round(100 * F.sum("common") / F.sum("k"), 6)).otherwise(F.lit(float("nan"))).alias("pct"))


def masked_positions(pairs: DataFrame, length: int) -> DataFrame:
    """query, pos (-1 where it is not valid) and visible of (query, idx): a position is valid within the length and seen if not ahead."""
    pos = F.when((F.col("idx") < 0) | (F.col("idx") >= length), -1).otherwise(F.col("idx"))
    return pairs.select("query", "idx", pos.alias("pos"), ((pos >= 0) & (pos <= F.col("query"))).alias("visible"))


def causal_scores(queries: DataFrame, keys: DataFrame, batch: str) -> DataFrame:
    """Scores of every query with the keys of its batch that are not ahead: (batch, row, pos, score)."""
    both = queries.join(keys, (queries[batch] == keys[f"k_{batch}"]) & (F.col("k_pos") <= F.col("pos")))
    return both.select(F.col(batch), F.col("pos").alias("row"), F.col("k_pos").alias("pos"), dot(F.col("q"), F.col("k")).alias("score"))


def softmax(scores: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Adds ``weight`` and ``lse`` within each key; -inf stands for masked.  A group that is masked wholly gives NaN weights."""
    whole = Window.partitionBy(*keys)
    rows = scores.withColumn("_top", F.max(score).over(whole))
    shifted_ = F.when(F.col("_top") == F.lit(float("-inf")), float("nan")).otherwise(F.exp(F.col(score) - F.col("_top")))
    rows = rows.withColumn("_e", shifted_).withColumn("_sum", F.sum("_e").over(whole))
    return rows.withColumns({"weight": F.col("_e") / F.col("_sum"), "lse": F.col("_top") + F.ln("_sum")}).drop("_top", "_e", "_sum")


def attended(weights: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted sums of the values (pos, value: a number) at the weights' positions: the gather join."""
    both = weights.join(values.withColumnRenamed("pos", "_p"), F.col("pos") == F.col("_p"))
    return both.groupBy(*keys).agg(F.round(F.sum(F.col("weight") * F.col("value")), 6).alias("out"))


def divergence_loss(scores: DataFrame, position: list[str], head: str, coefficient: float, eps: float = 1e-10) -> DataFrame:
    """loss: the mean over positions of the divergence between the heads' mean attention (softmax of p_score within a head) and
    the index distribution (softmax of q_score, one per position), times the coefficient.

    Columns: those of ``position``, ``head``, pos, p_score, q_score; q_score is the same for every head.
    """
    each = softmax(scores, [*position, head], "p_score").withColumnRenamed("weight", "p").drop("lse")
    mean = each.groupBy(*position, "pos").agg(F.avg("p").alias("p"), F.first("q_score").alias("q_score"))
    both = softmax(mean, position, "q_score").withColumnRenamed("weight", "q")
    kl = both.groupBy(*position).agg(F.sum(F.col("p") * (F.ln(F.col("p") + eps) - F.ln(F.col("q") + eps))).alias("kl"))
    return kl.agg(F.round(F.avg("kl") * coefficient, 6).alias("loss"))


def split_softmax(scores: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys, top, denominator of the softmax over (keys, pos, score), by parts of ``width`` positions: each part has a greatest
    score and a sum against it, and parts merge by the greater one.  A key's row count never meets in one task."""
    part = scores.withColumn("_part", F.expr(f"pos div {width}"))
    rows = part.withColumn("_m", F.max("score").over(Window.partitionBy(*keys, "_part")))
    sums = rows.groupBy(*keys, "_part", "_m").agg(F.sum(F.exp(F.col("score") - F.col("_m"))).alias("_d"))
    whole = sums.groupBy(*keys).agg(F.max("_m").alias("top"), F.collect_list(F.struct("_m", "_d")).alias("_parts"))
    total = F.aggregate("_parts", F.lit(0.0), lambda s, p: s + p["_d"] * F.exp(p["_m"] - F.col("top")))
    return whole.select(*keys, "top", total.alias("denominator"))


def divergence(scores: DataFrame, keys: list[str], eps: float = 1e-10) -> DataFrame:
    """Per key sum(p * (ln p - ln q)) of the softmaxes of columns p_score and q_score."""
    p = softmax(scores, keys, "p_score").withColumnRenamed("weight", "p").drop("lse")
    both = softmax(p, keys, "q_score").withColumnRenamed("weight", "q")
    return both.groupBy(*keys).agg(F.round(F.sum(F.col("p") * (F.ln(F.col("p") + eps) - F.ln(F.col("q") + eps))), 6).alias("kl"))


def weighted_loss(losses: DataFrame, decay: float) -> DataFrame:
    """The mean of (depth, loss, mask) per depth, weighted by decay ** depth, weights made to sum to 1."""
    each = losses.groupBy("depth").agg((F.sum(F.col("loss") * F.col("mask")) / F.greatest(F.sum("mask"), F.lit(1))).alias("mean"))
    each = each.withColumn("w", F.pow(F.lit(decay), F.col("depth")))
    return each.agg(F.round(F.sum(F.col("w") * F.col("mean")) / F.sum("w"), 6).alias("loss"))


def blocks(values: DataFrame, width: int) -> DataFrame:
    """id, block, absmax of (id, pos, x)."""
    return values.groupBy("id", F.expr(f"pos div {width}").alias("block")).agg(F.max(F.abs("x")).alias("absmax"))


def quantised_blocks(values: DataFrame, width: int) -> DataFrame:
    """id, pos, q and the value that q stands for."""
    rows = values.withColumn("absmax", F.max(F.abs("x")).over(Window.partitionBy("id", F.expr(f"pos div {width}"))))
    q = quantised(F.col("x"), F.col("absmax"))
    return rows.select("id", "pos", "x", q.alias("q"), dequantised(q, F.col("absmax")).alias("back"))


def folded(rows: DataFrame, key: str, order: str, columns: list[str], step: Callable, schema: str) -> DataFrame:
    """key, order, columns and the state after every row, in order within the key: ``step(state, *columns)`` gives the next state,
    from None.  ``schema`` names what to keep of these.

    Rows are dealt by key, sorted by Spark, and read batch by batch, so a series of any length is one pass in bounded memory.
    For recurrences that no window can express.
    """

    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for frame in batches:
            out = []
            for k, *values in frame[[key, *columns]].itertuples(index=False):
                state = step(None if k != last else state, *values)
                last = k
                out.append(state)
            yield frame.assign(state=out)[names]

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(key, order, *columns).repartition(parts, key).sortWithinPartitions(key, order)
    return dealt.mapInPandas(run, schema)


def momentum(steps: DataFrame, beta: float) -> DataFrame:
    """id, m after all steps (id, step, g): m = beta * m + (1 - beta) * g, kept as 8 bits of the largest gradient in between."""
    absmax = steps.groupBy("id").agg(F.max(F.abs("g")).alias("absmax"))

    def step(m: float | None, g: float, absmax: float) -> float:
        if not absmax:
            return 0.0
        scaled = (beta * (m or 0.0) + (1 - beta) * g) * 127 / absmax
        q = min(max(math.floor(abs(scaled) + 0.5), 0), 127)  # halves go away from zero
        return (q if scaled > 0 else -q) * absmax / 127

    each = folded(steps.join(absmax, "id"), "id", "step", ["g", "absmax"], step, "id long, step long, state double")
    return each.groupBy("id").agg(F.round(F.max_by("state", "step"), 6).alias("m"))


def segment_blocks(segments: DataFrame, width: int) -> DataFrame:
    """grp, block of the blocks that aligned segments (grp, start, len) cover."""
    first, last = F.expr(f"start div {width}"), F.expr(f"(start + len) div {width} - 1")
    return segments.filter("len > 0").select("grp", F.explode(F.sequence(first, last)).alias("block"))


def segment_errors(segments: DataFrame, width: int, n_blocks: int) -> DataFrame:
    """problem, n: segments out of line, blocks of several groups, blocks of none."""
    spark = segments.sparkSession
    out_of_line = segments.filter(f"start % {width} <> 0 or len % {width} <> 0").agg(F.lit("alignment").alias("problem"), F.count("*").alias("n"))
    cover = segment_blocks(segments.filter(f"start % {width} = 0 and len % {width} = 0"), width)
    shared = cover.groupBy("block").agg(F.countDistinct("grp").alias("g")).filter("g > 1").agg(F.lit("overlap").alias("problem"), F.count("*").alias("n"))
    missing = spark.range(n_blocks).withColumnRenamed("id", "block").join(cover.select("block").distinct(), "block", "left_anti").agg(F.lit("coverage").alias("problem"), F.count("*").alias("n"))
    return out_of_line.unionByName(shared).unionByName(missing)


def group_norms(values: DataFrame, cover: DataFrame, width: int, eps: float = 1e-7) -> DataFrame:
    """grp, scale: 1 / sqrt(max(sum of squares, eps ** 2)) over the group's blocks of (pos, x)."""
    sums = values.groupBy(F.expr(f"pos div {width}").alias("block")).agg(F.sum(F.col("x") * F.col("x")).alias("s"))
    each = sums.join(cover, "block").groupBy("grp").agg(F.sum("s").alias("s"))
    return each.select("grp", F.round(1 / F.sqrt(F.greatest("s", F.lit(eps * eps))), 9).alias("scale"))


def nearest_before(layers: DataFrame) -> DataFrame:
    """rank, source of (part, rank, is_full): the last full rank up to it; a layer with none before serves itself."""
    rows = last_value(layers.select("part", "rank", "is_full"), ["part"], ["rank"], F.when(F.col("is_full"), F.col("rank")), "full")
    return rows.select("part", "rank", F.coalesce("full", "rank").alias("source"), F.col("full").isNull().alias("promoted"))


def is_identity(rows: DataFrame) -> DataFrame:
    """grp, identity of (grp, pos, value): whether the sorted order is the given one."""
    return rows.groupBy("grp").agg(F.bool_and(F.col("pos") == F.col("value")).alias("identity"))


def unbroadcast(heads: DataFrame, group: int) -> DataFrame:
    """id, head, x: sums over each run of ``group`` heads."""
    return heads.groupBy("id", F.expr(f"head div {group}").alias("head")).agg(F.round(F.sum("x"), 6).alias("x"))


def looked_up(ids: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows (key, row) with the vector of their table row."""
    return ids.join(vectors.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left").drop("_row")


def running_angles(rows: DataFrame) -> DataFrame:
    """Adds ``angle``: the sum of x up to the row within id, in order of pos."""
    upto = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("angle", F.sum("x").over(upto))


def trapezoid(rows: DataFrame) -> DataFrame:
    """id, pos, scale = next dt * (1 - next gate) + dt * gate, gate the sigmoid of ``trap``; after the end dt is 0, the gate a half."""
    order = Window.partitionBy("id").orderBy("pos")
    gate = sigmoid(F.col("trap"))
    after, gate_after = F.lead("dt", 1, 0.0).over(order), F.lead("gate", 1, 0.5).over(order)
    return rows.withColumn("gate", gate).select("id", "pos", F.round(after * (1 - gate_after) + F.col("dt") * F.col("gate"), 6).alias("scale"))


def recurrence(rows: DataFrame) -> DataFrame:
    """id, pos, h of h = f * h + (1 - f) * tanh(h * w + x) over (id, pos, x, f, w): not associative, so each id is one pass."""

    def step(h: float | None, x: float, f: float, w: float) -> float:
        h = h or 0.0
        return f * h + (1 - f) * math.tanh(h * w + x)

    return folded(rows, "id", "pos", ["x", "f", "w"], step, "id long, pos long, state double").withColumnRenamed("state", "h")


#: Share of a state by which a chunk's start may move in the last round.
STILL = 1e-13


def chunked_states(rows: DataFrame, width: int) -> DataFrame:
    """id, chunk, _start, _items: the state before each chunk of ``width`` positions of ``recurrence``; all chunks run side by side.

    Every chunk runs from a guess and gives its end and the slope of its end to its start.  These are maps start -> end, straight
    lines near the guess, which a blocked scan chains into the next guesses (Newton's step for all chunks at once).  The first chunk's
    start is known, so each round settles one chunk more at least; a few rounds do when states forget or the lines are good.
    """
    items = F.sort_array(F.collect_list(F.struct("pos", F.struct("x", "f", "w").alias("m")))).alias("_items")
    chunks = stored(rows.groupBy("id", F.expr(f"pos div {width}").alias("chunk")).agg(items), "recurrence-chunks")
    chunks = stored(chunks.select(F.monotonically_increasing_id().alias("_n"), "*"), "recurrence-numbered")

    def step(s: Column, item: Column) -> Column:
        m, t = item["m"], F.tanh(s["h"] * item["m"]["w"] + item["m"]["x"])
        return F.struct((m["f"] * s["h"] + (1 - m["f"]) * t).alias("h"), (s["j"] * (m["f"] + (1 - m["f"]) * m["w"] * (1 - t * t))).alias("j"))

    starts = stored(chunks.select("_n", "id", "chunk", F.lit(0.0).alias("_start")), "recurrence-starts")
    both = lambda f, g: F.struct((f["a"] * g["a"]).alias("a"), (g["a"] * f["b"] + g["b"]).alias("b"))
    while True:
        run = chunks.select("_n", "_items").join(starts, "_n")
        end = F.aggregate("_items", F.struct(F.col("_start").alias("h"), F.lit(1.0).alias("j")), step)
        lines = run.withColumn("_e", end).select("_n", "id", "chunk", F.col("_start").alias("_was"), F.col("_e.j").alias("a"), (F.col("_e.h") - F.col("_e.j") * F.col("_start")).alias("b"))
        moved = scanned(lines, ["id"], ["chunk"], F.struct("a", "b"), F.lit(0.0), lambda x, m: m["a"] * x + m["b"], both, "_start", before=True)
        moved = stored(moved.select("_n", "id", "chunk", "_was", "_start"), "recurrence-starts")
        starts = moved.drop("_was")
        if not moved.filter(F.abs(F.col("_start") - F.col("_was")) > STILL * (1 + F.abs("_start"))).limit(1).count():
            return chunks.select("_n", "_items").join(starts, "_n").drop("_n")


def chunked_recurrence(rows: DataFrame, width: int) -> DataFrame:
    """As ``recurrence``, by chunks that run side by side: id, chunk, h at the end of each chunk of ``width`` positions."""
    step = lambda h, item: item["m"]["f"] * h + (1 - item["m"]["f"]) * F.tanh(h * item["m"]["w"] + item["m"]["x"])
    return chunked_states(rows, width).select("id", "chunk", F.aggregate("_items", F.col("_start"), step).alias("h"))


def _objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json

    decoder = json.JSONDecoder()

    def first(text: str | None) -> str | None:
        at = (text or "").find("{")
        while at >= 0:
            try:
                return json.dumps(decoder.raw_decode(text, at)[0], sort_keys=True)
            except ValueError:
                at = text.find("{", at + 1)
        return None

    for frame in batches:
        yield pd.DataFrame({"id": frame["id"], "object": frame["value"].map(first)})


def first_objects(rows: DataFrame) -> DataFrame:
    """id, object of (id, value): the first JSON object in noisy text; finding it needs backtracking, hence Python."""
    return rows.select("id", "value").mapInPandas(_objects, "id long, object string")
