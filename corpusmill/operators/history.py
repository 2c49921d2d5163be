"""Metric history: snapshots (port, ts, ord, step, loss, ...) deduplicated, kept for a while, and turned into trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.scans import running_mean

KEPT_ROWS, CHART_ROWS = 50_000, 2_000
TARGETS, AHEAD = (1.0, 0.5, 0.1), (1000, 5000, 10000)


def changed(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose step is not that of the port's snapshot before."""
    before = F.lag("step").over(Window.partitionBy("port").orderBy("ord"))
    first = F.row_number().over(Window.partitionBy("port").orderBy("ord")) == 1
    return snapshots.withColumn("_new", first | ~F.col("step").eqNullSafe(before)).filter("_new").drop("_new")


def retained(snapshots: DataFrame, n: int = KEPT_ROWS) -> DataFrame:
    """The last n snapshots of all ports."""
    return snapshots.orderBy(F.desc("ord")).limit(n)


def chart_rows(snapshots: DataFrame, n: int = CHART_ROWS) -> DataFrame:
    """The last n snapshots of each port."""
    rank = F.row_number().over(Window.partitionBy("port").orderBy(F.desc("ord")))
    return snapshots.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def valid(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter("loss is not null and step is not null")


def recent(snapshots: DataFrame) -> DataFrame:
    """Of each port's valid snapshots the last max(10, a fifth)."""
    whole = Window.partitionBy("port")
    rows = valid(snapshots).withColumns({"_n": F.count("*").over(whole), "_rank": F.row_number().over(whole.orderBy(F.desc("ord")))})
    return rows.filter(F.expr("_rank <= greatest(10, _n div 5)")).drop("_n", "_rank")


def regression(rows: DataFrame, x: str, y: str) -> DataFrame:
    """port, slope, intercept by least squares; one point, or no spread in x, gives slope 0 and the mean."""
    sums = rows.groupBy("port").agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col(x).cast("double")).alias("sx"), F.sum(y).alias("sy"), F.sum(F.col(x).cast("double") * F.col(y)).alias("sxy"),
        F.sum(F.col(x).cast("double") * F.col(x)).alias("sxx"),
    )
    spread = F.expr("n * sxx - sx * sx")
    slope = F.when((F.col("n") < 2) | (F.abs(spread) < 1e-12), 0.0).otherwise(F.expr("(n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0)"))
    return sums.withColumn("slope", slope).select("port", "slope", F.expr("(sy - slope * sx) / n").alias("intercept"))


def trends(snapshots: DataFrame) -> DataFrame:
    """Trend, forecasts and steps to targets per port with at least two valid snapshots.

    Steps to a target are null unless the trend falls, the last loss is above it and the line meets it ahead.
    """
    rows = valid(snapshots)
    facts = rows.groupBy("port").agg(F.count("*").alias("n_points"), F.max_by("step", "ord").alias("step"), F.max_by("loss", "ord").alias("loss")).filter("n_points >= 2")
    out = facts.join(regression(recent(snapshots), "step", "loss"), "port")
    ahead = [F.round(F.col("slope") * (F.col("step") + a) + F.col("intercept"), 4).alias(f"loss_{a}") for a in AHEAD]

    def steps_to(target: float) -> Column:
        left = (F.lit(target) - F.col("intercept")) / F.nullif(F.col("slope"), F.lit(0.0)) - F.col("step")
        return F.when((F.col("slope") < 0) & (F.col("loss") > target) & (left > 0), left.cast("long")).alias("steps_to_" + str(target).replace(".", "_"))

    return out.select(
        "port", "n_points", F.expr("greatest(10, n_points div 5)").alias("window_size"), F.round("slope", 8).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round(F.col("slope") * 1000, 4).alias("loss_per_1k"), *ahead, *map(steps_to, TARGETS),
    )


def trendline(snapshots: DataFrame) -> DataFrame:
    """port, x, y at the first and last step and a fifth of the span beyond, on the rounded line."""
    span = valid(snapshots).groupBy("port").agg(F.min_by("step", "ord").alias("first"), F.max_by("step", "ord").alias("last"))
    rows = span.join(regression(recent(snapshots), "step", "loss"), "port")
    places = F.explode(F.array("first", "last", F.col("last") + F.floor(F.lit(0.2) * (F.col("last") - F.col("first"))).cast("long")))
    rows = rows.select("port", places.alias("x"), F.round("slope", 8).alias("a"), F.round("intercept", 4).alias("b"))
    return rows.select("port", "x", F.round(F.col("a") * F.col("x") + F.col("b"), 4).alias("y"))


def smoothed(snapshots: DataFrame, alpha: float, digits: int = 4) -> DataFrame:
    """port, ord, ema: the running mean of loss, from its first value on; null where the loss is null.  A port of any length is
    scanned by blocks."""
    loss = F.when(~F.isnan("loss"), F.col("loss"))
    rows = running_mean(snapshots.select("port", "ord", "loss"), ["port"], ["ord"], loss, alpha, "state")
    return rows.select("port", "ord", F.when(loss.isNotNull(), F.round("state", digits)).alias("ema"))


def latest_smoothed(snapshots: DataFrame, alpha: float = 0.1) -> DataFrame:
    """port, ema of the valid snapshots' last one."""
    rows = smoothed(valid(snapshots), alpha)
    return rows.groupBy("port").agg(F.max_by("ema", "ord").alias("ema"))


def run_summary(snapshots: DataFrame) -> DataFrame:
    """One row per run: first and last step, last loss and rate, first time, count."""
    return snapshots.groupBy("port").agg(
        F.min_by("step", "ord").alias("first_step"), F.max_by("step", "ord").alias("last_step"), F.max_by("loss", "ord").alias("last_loss"),
        F.min("ts").cast("string").alias("first_ts"), F.count("*").alias("n"),
    )


def status(processes: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Each known port with its last snapshot, or as unreachable."""
    last = snapshots.groupBy("port").agg(F.max_by("step", "ord").alias("step"))
    return processes.join(last, "port", "left").select("port", "step", F.col("step").isNotNull().alias("reachable"))
