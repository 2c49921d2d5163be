"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Native operator: DataFrame functions only.

Every document gets the base counts of ``with_counts`` and four rates in parts per ``SCALE``.  For each rate the
documents of a (lang, source) group are summarised by a sketch: a histogram over bins that hold the upper ``BIN_BITS`` bits
of the rate (exact below 2 ** BIN_BITS, within 1 / 2048 above, without an upper end), which merges by adding counts,
whatever the partitioning.  The sketches of a language's sources merge to a language sketch.  A group of n documents takes
its quartiles as the mean of its own, with weight n, and its language's, with weight ``PRIOR``, so a small group leans on
its language and a large one on itself.  A rate is rejected when it lies beyond median + ``FENCE`` * max(interquartile
range, least width of the rate) of its group (and, for word length, also below).

Defined cases: null text counts as empty (no words: base_failed); texts of any length are counted whole; null lang or source is a group of its own; repeated
rows are judged one by one; an empty table gives an empty result; other columns are carried along untouched and cannot
clash because every helper column starts with ``_q``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import small, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
PRIOR = 30
FENCE = 8
SCALE = 1000
#: Rate -> (numerator, denominator, least width of the interquartile range, also bounded below).
RATES = {
    "symbols": ("n_symbols", "_q_chars", 4, False),
    "dup_lines": ("n_dup_lines", "_q_lines", 60, False),
    "repeats": ("n_repeat_words", "n_words", 45, False),
    "word_length": ("word_chars", "n_words", 400, True),
}
BIN_BITS = 12
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts in ``COUNTS``, ``base_failed`` and helper columns ``_q_chars`` and ``_q_lines``."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_q_words", F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    # Windows are compared by a 64-bit hash chained over their three words.
    out = out.withColumn(
        "_q_windows",
        F.when(
            F.size("_q_words") >= 3,
            F.expr("transform(sequence(0, size(_q_words) - 3), i -> xxhash64(_q_words[i], _q_words[i + 1], _q_words[i + 2]))"),
        ).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    out = out.withColumn("_q_solid", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # Start positions of repeated windows, in order; each covers three words, overlaps counted once.
    repeated = """
        case when size(array_distinct(_q_windows)) = size(_q_windows) then 0L
        else aggregate(
            array_sort(transform(filter(
                transform(array(array_sort(transform(_q_windows, (h, i) -> struct(h as h, i as i)))), s ->
                    filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k < size(s) - 1 and s[k + 1].h = x.h)))[0],
                x -> true), x -> x.i)),
            struct(0L as n, -3 as last),
            (a, p) -> struct(a.n + least(3, p - a.last) as n, p as last),
            a -> a.n)
        end"""
    out = out.withColumns(
        {
            "n_words": F.size("_q_words").cast("long"),
            "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_q_solid") - F.size(F.array_distinct("_q_solid"))).cast("long"),
            "n_repeat_words": F.expr(repeated),
            "_q_lines": F.size("_q_solid").cast("long"),
            "_q_chars": F.length(body).cast("long"),
        }
    ).drop("_q_words", "_q_windows", "_q_solid")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def rate_bin(rate: str) -> Column:
    """The sketch bin of a rate: its whole parts per SCALE, cut to their upper BIN_BITS bits."""
    top, below, _, _ = RATES[rate]
    parts = f"{SCALE} * {top} div greatest({below}, 1)"
    low = f"greatest(length(bin({parts})) - {BIN_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright(cast({parts} as bigint), {low}), {low})")


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, rate, bin, n) of the documents that pass the base rules; merging adds n."""
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), rate_bin(r).alias("bin")) for r in RATES]))
    return (
        counted.filter(~F.col("base_failed"))
        .select("lang", "source", bins.alias("_q"))
        .groupBy("lang", "source", F.col("_q.rate").alias("rate"), F.col("_q.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """n, first quartile, median and third quartile of the merged sketch of each group: the lowest bins that reach them."""
    group = ", ".join(keys)
    merged = sketch.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    ranked = merged.selectExpr(
        "*",
        f"sum(n) over (partition by {group} order by bin rows unbounded preceding) as upto",
        f"sum(n) over (partition by {group}) as total",
    )
    at = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bin")))
    return ranked.groupBy(*keys).agg(F.max("total").alias("total"), at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"))


def thresholds(counted: DataFrame) -> DataFrame:
    """One row per (lang, source): low and high bound of each rate, as columns ``_q_low_<rate>`` and ``_q_high_<rate>``."""
    sketch = sketches(counted)
    own, whole = quartiles(sketch, ["lang", "source", "rate"]), quartiles(sketch, ["lang", "rate"])
    used = own.alias("o").join(whole.alias("w"), F.expr("o.lang <=> w.lang and o.rate = w.rate")).selectExpr(
        "o.lang as lang", "o.source as source", "o.rate as rate",
        *[f"(o.total * o.{q} + {PRIOR} * w.{q}) div (o.total + {PRIOR}) as {q}" for q in ("q1", "q2", "q3")],
    )
    floor = reduce(lambda c, r: c.when(F.col("rate") == r, RATES[r][2]), RATES, F.when(F.lit(False), 0))
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), floor)
    bounds = used.select("lang", "source", "rate", (F.col("q2") + reach).alias("high"), (F.col("q2") - reach).alias("low"))
    pick = lambda side, r: F.max(F.when(F.col("rate") == r, F.col(side))).alias(f"_q_{side}_{r}")
    return bounds.groupBy("lang", "source").agg(*[pick(s, r) for r in RATES for s in ("low", "high")])


def judged(counted: DataFrame, bounds: DataFrame) -> DataFrame:
    """``counted`` with ``kept``; documents that fail the base rules are not kept."""
    b = bounds.withColumnsRenamed({"lang": "_q_lang", "source": "_q_source"})
    joined = counted.join(b, counted["lang"].eqNullSafe(b["_q_lang"]) & counted["source"].eqNullSafe(b["_q_source"]), "left")
    fits = ~F.col("base_failed")
    for rate, (_, _, _, below) in RATES.items():
        fits &= rate_bin(rate) <= F.col(f"_q_high_{rate}")
        if below:
            fits &= rate_bin(rate) >= F.col(f"_q_low_{rate}")
    return joined.withColumn("kept", F.coalesce(fits, F.lit(False)))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    Every text is counted once: the rows are stored with their counts, for both the thresholds and the filter.
    """
    rows = with_counts(docs.select("text", "lang", "source", F.struct(*docs.columns).alias("_q_doc"))).drop("text")
    counted = stored(rows, "quality-counts")
    bounds = small(stored(thresholds(counted), "quality-bounds"))
    return judged(counted, bounds).filter("kept").select("_q_doc.*")
