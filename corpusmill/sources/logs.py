"""Text logs: numbered lines, tails, sections and fixed-column tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """run (file name), line_no and value of every line of the files under ``path`` that is not empty; undecodable bytes become U+FFFD.

    Files are read in splits of any number.  Lines come in order within a split, so a line's number is its place there, and
    the lines of the splits before; only the splits' counts meet.
    """
    file, start = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    rows = spark.read.text(path).select(file, start, F.monotonically_increasing_id().alias("_id"), "value")
    before = Window.partitionBy("_f").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy(F.col("_file").alias("_f"), F.col("_start").alias("_s")).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    both = rows.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s"))).filter("value <> ''")
    return both.select(F.element_at(F.split("_file", "/"), -1).alias("run"), (F.col("_id") - F.col("_first") + F.col("_before")).alias("line_no"), "value")


def tail(lines: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """The last n lines, in order."""
    return lines.orderBy(F.desc(order)).limit(n).orderBy(order)


def tail_per_run(lines: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """The last n lines of each run."""
    rank = F.row_number().over(Window.partitionBy("run").orderBy(F.desc(order)))
    return lines.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def section(lines: DataFrame, marker: Column, end: Column | None = None) -> DataFrame:
    """The lines of each run after its marker line, before the first end line after it."""
    upto = Window.partitionBy("run").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("_in", F.max(marker.cast("int")).over(upto))
    ended = F.lit(0) if end is None else F.max((end & (F.col("_in") == 1)).cast("int")).over(upto)
    return rows.withColumn("_out", ended).filter((F.col("_in") == 1) & (F.col("_out") == 0) & ~marker).drop("_in", "_out")


def columns(value: Column, most: int) -> Column:
    """The columns of a table line, apart by two or more spaces; the last takes the rest."""
    return F.split(F.trim(value), r"\s{2,}", most)


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` whose columns are worked out once: a filter on them is not moved below, where it would work them out again and again."""
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_r")).select("_r.*")
