"""Global prefix sums and row numbers without a single-partition window.

The order key is an integer; rows are grouped in blocks of neighbouring keys, of about ``BLOCK`` rows when keys lie evenly,
dense or not.  A block's total, and the totals before it, come from a table with one row per block; only the sums inside a
block need its rows together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.sources.tables import scratch_path

BLOCK = 1 << 16


def block_width(df: DataFrame, key: str, rows: int = BLOCK) -> int:
    """Keys that a block spans so that it holds about ``rows`` of the rows; one pass over the key alone."""
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    return max(1, (high - low + 1) * rows // n) if n else rows


def prefix_sums(df: DataFrame, key: str, values: dict[str, Column], block: int | None = None) -> DataFrame:
    """Adds each ``values`` name: the sum of its value over all rows with a smaller ``key`` (keys are unique), 0 for the first.

    All sums share one aggregation, one join with the blocks' offsets and one window.
    """
    names, block = list(values), block or block_width(df, key)
    rows = df.withColumns({"_block": F.expr(f"{key} div {block}"), **{f"_v_{n}": v for n, v in values.items()}})
    totals = rows.groupBy("_block").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_block", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names])
    own = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    sums = {n: F.col(f"_o_{n}") + F.coalesce(F.sum(f"_v_{n}").over(own), F.lit(0)) for n in names}
    return rows.join(offsets, "_block").withColumns(sums).drop("_block", *[f"_{k}_{n}" for k in "vo" for n in names])


def prefix_sum(df: DataFrame, key: str, value: Column, out: str, block: int | None = None) -> DataFrame:
    return prefix_sums(df, key, {out: value}, block)


def ordinals(df: DataFrame, key: str, out: str = "ord", block: int | None = None) -> DataFrame:
    """Adds ``out``: the number of rows with a smaller ``key``, from 0."""
    return prefix_sums(df, key, {out: F.lit(1).cast("long")}, block)


def row_numbers(df: DataFrame, order: list[str], out: str = "ord") -> DataFrame:
    """Adds ``out``: the place of each row from 0 by any columns; rows are sorted by ranges, stored with their place in their
    range, and only the ranges' counts meet.  Tied rows get places in some order, the same wherever the result is read."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "row-numbers")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The id holds the partition above 33 bits and the place in it below.
    placed = placed.withColumn("_id", F.monotonically_increasing_id())
    placed.withColumns({"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id").write.parquet(path)
    rows = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(counts), "_range").withColumn(out, F.col("_before") + F.col("_at")).drop("_range", "_at", "_before")
