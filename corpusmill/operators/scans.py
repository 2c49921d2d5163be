"""Ordered scans of any length by blocks: what a key's state is after each of its rows, when maps of the state compose.

A row stands for a map of the state.  Rows are sorted by key and order in ranges, so that the rows of a hot key lie in many; a
range is cut into blocks of ``BLOCK`` rows.  A block's rows compose to one map, the blocks of a key in a range to one, and the
ranges of a key are gone through in order: one row per key and range.  The states found go back down the same steps, and every
block is run from its own.  All of it is done by the built-in functions, and no task is bound to a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from corpusmill.sources.tables import scratch_path

#: Rows of a block.  Running through n items copies n * n / 2 states: rows of a block, blocks of a key in a range, ranges of a key.
BLOCK = 512

Apply = Callable[[Column, Column], Column]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(rows: DataFrame, keys: list[str], order: list[str], maps: Column, block: int | None = None) -> DataFrame:
    """The keys, _range, _first (together unique) and _items (_at, r: the row, m: its map), in order, of every block; stored.

    Rows tied in ``order`` are put in order by their other columns.
    """
    loose = [f.name for f in rows.schema if f.name not in (*keys, *order) and not isinstance(f.dataType, MapType | VariantType)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(c) for c in rows.columns]).alias("r"), maps.alias("m"))
    at = [*[F.col(f"_k{i}") for i in range(len(keys))], *[F.col("r")[c] for c in order]]
    placed = own.repartitionByRange(parts, *at).sortWithinPartitions(*at, *[F.col("r")[c] for c in loose])
    placed = placed.withColumn("_id", F.monotonically_increasing_id())  # the partition above 33 bits, the place in it below
    placed = placed.withColumns({"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    each = placed.groupBy(*[f"_k{i}" for i in range(len(keys))], "_range", F.expr(f"_at div {block or BLOCK}").alias("_sub"))
    return stored(each.agg(F.min("_at").alias("_first"), F.sort_array(F.collect_list(F.struct("_at", "r", "m"))).alias("_items")).drop("_sub"), "scan-blocks")


def running(items: Column, start: Column, apply: Apply) -> Column:
    """The state before the first item, and after each."""
    return F.aggregate(items, F.array(start), lambda states, item: F.concat(states, F.array(apply(F.element_at(states, -1), item["m"]))))


def _composed(items: Column, compose: Apply) -> Column:
    return F.aggregate(F.slice(items, 2, F.size(items)), items[0]["m"], lambda f, item: compose(f, item["m"]))


def _handed(rows: DataFrame, items: str, start: Column, apply: Apply) -> DataFrame:
    """_range, _first of the items, with the state before each."""
    states = running(F.col(items), start, apply)
    each = F.explode(F.arrays_zip(F.col(items).alias("item"), F.slice(states, 1, F.size(items)).alias("x")))
    return rows.select(each.alias("e")).select("e.item._range", "e.item._first", F.col("e.x").alias("_x"))


def starts(own: DataFrame, start: Column, apply: Apply, compose: Apply) -> DataFrame:
    """_range, _first and _x, the state before each of the blocks; stored."""
    keys = [c for c in own.columns if c.startswith("_k")]
    each = own.select(*keys, "_range", "_first", _composed(F.col("_items"), compose).alias("m"))
    ranges = each.groupBy(*keys, "_range").agg(F.sort_array(F.collect_list(F.struct("_range", "_first", "m"))).alias("_blocks"))
    ranges = stored(ranges.withColumn("_head", F.col("_blocks")[0]["_first"]), "scan-ranges")
    one = ranges.select(*keys, F.struct("_range", F.col("_head").alias("_first"), _composed(F.col("_blocks"), compose).alias("m")).alias("s"))
    whole = one.groupBy(*keys).agg(F.sort_array(F.collect_list("s")).alias("_ranges"))
    heads = _handed(whole, "_ranges", start, apply).select(F.col("_range").alias("_r"), F.col("_first").alias("_f"), F.col("_x").alias("_in"))
    both = ranges.join(heads, (F.col("_range") == F.col("_r")) & (F.col("_head") == F.col("_f")))
    return stored(_handed(both, "_blocks", F.col("_in"), apply), "scan-starts")


def spread(own: DataFrame, begun: DataFrame, apply: Apply, out: str, before: bool = False) -> DataFrame:
    """The rows of the blocks with the state after each (or before it) as ``out``."""
    begun = begun.select(F.col("_range").alias("_r"), F.col("_first").alias("_f"), "_x")
    both = own.join(begun, (F.col("_range") == F.col("_r")) & (F.col("_first") == F.col("_f")))
    states = F.slice(running(F.col("_items"), F.col("_x"), apply), 1 if before else 2, F.size("_items"))
    rows = both.select(F.explode(F.arrays_zip(F.col("_items").alias("item"), states.alias("x"))).alias("e"))
    return rows.select("e.item.r.*", F.col("e.x").alias(out))


def scanned(rows: DataFrame, keys: list[str], order: list[str], maps: Column, start: Column, apply: Apply, compose: Apply, out: str, before: bool = False) -> DataFrame:
    """The rows with the state after each (or before it) within its keys as ``out``.

    ``maps`` is a struct, the map that a row stands for; ``apply(state, map)`` gives the next state, ``compose(first, then)`` the
    map of both.  Null keys are one key, no rows give none, a column of the name ``out`` is replaced.
    """
    rows = rows.drop(out)
    own = blocks(rows, keys, order, maps)
    return spread(own, starts(own, start, apply, compose), apply, out, before)


def ranged(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows with _range and _at (the place in it), sorted by keys and order in ranges; stored.  Rows tied in ``order`` are put in
    order by their other columns."""
    loose = [f.name for f in rows.schema if f.name not in (*keys, *order) and not isinstance(f.dataType, MapType | VariantType)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order, *loose)
    placed = placed.withColumn("_id", F.monotonically_increasing_id())  # the partition above 33 bits, the place in it below
    placed = placed.withColumns({"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    return stored(placed.drop("_id"), "scan-rows")


def handed(own: DataFrame, keys: list[str], totals: list[Column], before: Column) -> DataFrame:
    """``own`` (``ranged``) with _x: for a key that began in an earlier range ``before``, over the ``totals`` of its ranges in ``_t`` up to
    this one, else null.  One row per key and range is summed up, few of them are left."""
    at = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy(*keys, "_range").agg(F.struct(*totals).alias("_t"))
    carried = sums.withColumn("_ranges", F.collect_list(F.struct("_range", "_t")).over(at)).filter(F.size("_ranges") > 0)
    carried = stored(carried.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), before.alias("_x")), "scan-carried")
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_c{i}"))
    # At most one key goes on in each range.
    return own.join(F.broadcast(carried), same, "left").drop("_r", *[f"_c{i}" for i in range(len(keys))])


def last_value(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, before: bool = False) -> DataFrame:
    """Adds ``out``: the last non-null value up to the row (or before it), null where there is none."""
    kind = rows.select(value.alias("v")).schema[0].dataType
    maps = F.struct(value.alias("v"))
    return scanned(rows, keys, order, maps, F.lit(None).cast(kind), lambda x, m: F.coalesce(m["v"], x), lambda f, g: F.struct(F.coalesce(g["v"], f["v"]).alias("v")), out, before)


def clamped_sum(rows: DataFrame, keys: list[str], order: list[str], change: Column, out: str, least: int = 0) -> DataFrame:
    """Adds ``out``: the sum of the changes so far from ``least`` on, which never falls below it."""
    maps = F.struct(change.cast("long").alias("a"), F.lit(least).cast("long").alias("b"))  # x -> max(x + a, b)
    both = lambda f, g: F.struct((f["a"] + g["a"]).alias("a"), F.greatest(f["b"] + g["a"], g["b"]).alias("b"))
    return scanned(rows, keys, order, maps, F.lit(least).cast("long"), lambda x, m: F.greatest(x + m["a"], m["b"]), both, out)


def numbered(rows: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the place of the row within its keys from 1."""
    maps = F.struct(F.lit(1).cast("long").alias("n"))
    return scanned(rows, keys, order, maps, F.lit(0).cast("long"), lambda x, m: x + m["n"], lambda f, g: F.struct((f["n"] + g["n"]).alias("n")), out)


def running_mean(rows: DataFrame, keys: list[str], order: list[str], value: Column, alpha: float, out: str) -> DataFrame:
    """Adds ``out``: x -> alpha * value + (1 - alpha) * x from the first non-null value on, which is itself the mean; nulls leave it."""
    known = value.isNotNull()
    maps = F.struct(value.alias("n"), F.when(known, 1 - alpha).otherwise(1.0).alias("a"), F.when(known, alpha * value).otherwise(0.0).alias("b"))

    def apply(x: Column, m: Column) -> Column:
        return F.when(x.isNull(), m["n"]).otherwise(m["b"] + m["a"] * x)

    def compose(f: Column, g: Column) -> Column:
        return F.struct(apply(f["n"], g).alias("n"), (f["a"] * g["a"]).alias("a"), (g["b"] + g["a"] * f["b"]).alias("b"))

    return scanned(rows, keys, order, maps, F.lit(None).cast("double"), apply, compose, out)
