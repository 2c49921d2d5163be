"""Exact order statistics of groups of any size, without sorting a group or bringing it together.

A group's values are counted in ``BINS`` equal parts of the range at hand, in every task before the counts meet; the part that
holds the wanted rank becomes the next range, as wide as the values that lie in it.  Once a part holds few values, these are
gathered and sorted.  A part of one value needs no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.scans import stored

BINS = 256
#: Values of a part that are gathered; more are counted again.
GATHER = 4096


def order_statistics(rows: DataFrame, keys: list[str], value: str, ranks: dict[str, str]) -> DataFrame:
    """keys, n and for each name of ``ranks`` the value at that rank, ascending from 1, an expression of n, the group's values.

    Values are numbers; nulls and NaN are none, infinities are.  A group without values gives no row, a rank outside 1 to n null.
    """
    own = rows.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    names, finite = [f"_k{i}" for i in range(len(keys))], F.abs("_v") != F.lit(float("inf"))
    spans = own.groupBy(*names).agg(F.count("*").alias("n"), F.min(F.when(finite, F.col("_v"))).alias("low"), F.max(F.when(finite, F.col("_v"))).alias("high"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("name"), F.expr(e).cast("long").alias("rank")) for r, e in ranks.items()])).alias("s")
    zero, edge = F.lit(0).cast("long"), lambda c: F.coalesce(c, F.lit(0.0))
    groups = stored(spans.select(*names, "n", "low", "high"), "select-groups")
    state = groups.select(*names, "n", edge(F.col("low")).alias("low"), edge(F.col("high")).alias("high"), each).select(*names, "s.*", "low", "high", zero.alias("below"), F.col("n").alias("held"), F.lit(None).cast("double").alias("found"))
    state = stored(state.filter("rank between 1 and held"), "select-state")
    same = [*names, "name"]
    match = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    part = F.expr(f"case when _v < low then -1 when _v > high then {BINS} when low = high then 0 else least({BINS - 1}, cast(floor((_v / 2 - low / 2) / (high / 2 - low / 2) * {BINS}) as int)) end")
    first = True
    while (open_ := state.filter(f"found is null and held > {GATHER}" if not first else "true")).limit(1).count():
        # The first round tells infinite values, which lie beyond the range, from the others.
        within = F.lit(True) if first else F.expr("_v between low and high")
        seen = own.alias("o").join(open_.alias("w"), match("o", "w")).filter(within).select(*[F.col(f"w.{c}").alias(c) for c in same], part.alias("bin"), "_v")
        counts = seen.groupBy(*same, "bin").agg(F.count("*").alias("c"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        bins = counts.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("bin", "c", "least", "most"))).alias("bins"))  # BINS + 2 at most
        both = state.alias("w").join(bins.alias("b"), [*match("w", "b"), F.col("w.name") == F.col("b.name")], "left")
        start = F.struct(F.col("w.below").alias("below"), zero.alias("held"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"))
        step = lambda s, b: F.when(s["below"] + s["held"] >= F.col("w.rank"), s).otherwise(F.struct((s["below"] + s["held"]).alias("below"), b["c"].alias("held"), b["least"].alias("low"), b["most"].alias("high")))
        there = F.col("b.bins").isNotNull()
        both = both.withColumn("hit", F.when(there, F.aggregate("b.bins", start, step)))
        keep = lambda c: F.coalesce(F.col(f"hit.{c}"), F.col(f"w.{c}"))
        one = F.when(F.col("hit.low") == F.col("hit.high"), F.col("hit.low"))
        state = stored(both.select(*[F.col(f"w.{c}").alias(c) for c in same], "w.rank", keep("low").alias("low"), keep("high").alias("high"), keep("below").alias("below"), keep("held").alias("held"), F.coalesce("w.found", one).alias("found")), "select-state")
        first = False
    rest = own.alias("o").join(state.filter("found is null").alias("w"), match("o", "w")).filter("_v between low and high")
    got = rest.groupBy(*[F.col(f"w.{c}").alias(c) for c in same], "rank", "below").agg(F.sort_array(F.collect_list("_v")).alias("vs"))
    got = got.select(*same, F.element_at("vs", (F.col("rank") - F.col("below")).cast("int")).alias("x")).unionByName(state.filter("found is not null").select(*same, F.col("found").alias("x")))
    wide = got.groupBy(*names).agg(*[F.max(F.when(F.col("name") == r, F.col("x"))).alias(f"_x_{r}") for r in ranks])
    out = groups.select(*names, "n").alias("o").join(wide.alias("w"), match("o", "w"), "left")
    return out.select(*[F.col(f"o._k{i}").alias(c) for i, c in enumerate(keys)], "n", *[F.col(f"_x_{r}").alias(r) for r in ranks])
