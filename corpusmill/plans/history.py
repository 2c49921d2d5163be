"""Metric history over ``events``: port is the user, ord the event, step a third of it, so steps repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.scalars import readable_eta, used_percent
from corpusmill.operators import history
from corpusmill.plans.registry import query
from corpusmill.sources.tables import table

S = "s as (select user_id as port, event_id as ord, event_id // 400 as step, ts, case when event_id % 13 = 0 then null else value end as loss from events)"
V = f"{S}, v as (select * from s where loss is not null)"
R = f"""{V}, r as (select *, count(*) over (partition by port) as n, row_number() over (partition by port order by ord desc) as k from v), w as (select * from r where k <= greatest(10, n // 5)),
g as (select port, count(*)::double as n, sum(step::double) as sx, sum(loss) as sy, sum(step::double * loss) as sxy, sum(step::double * step) as sxx from w group by port),
l as (select port, case when n < 2 or abs(n * sxx - sx * sx) < 1e-12 then 0.0 else (n * sxy - sx * sy) / (n * sxx - sx * sx) end as slope, * exclude port from g),
line as (select port, slope, (sy - slope * sx) / n as intercept from l), f as (select port, count(*) as n_points, max_by(step, ord) as step, max_by(loss, ord) as loss from v group by port having count(*) >= 2)"""


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("user_id as port", "event_id as ord", "event_id div 400 as step", "ts", "if(event_id % 13 = 0, null, value) as loss")


@query(f"with {S}, c as (select *, lag(step) over (partition by port order by ord) as b, row_number() over (partition by port order by ord) as k from s) select port, ord, step from c where k = 1 or step is distinct from b")
def history_changed(spark: SparkSession, d: str) -> DataFrame:
    return history.changed(_snapshots(spark, d)).select("port", "ord", "step")


@query(f"with {S} select port, ord from s order by ord desc limit 3000")
def history_retained(spark: SparkSession, d: str) -> DataFrame:
    return history.retained(_snapshots(spark, d), 3000).select("port", "ord")


@query(f"with {S} select port, ord from (select *, row_number() over (partition by port order by ord desc) as k from s) where k <= 20")
def history_chart_rows(spark: SparkSession, d: str) -> DataFrame:
    return history.chart_rows(_snapshots(spark, d), 20).select("port", "ord")


@query(f"with {R} select port, round(slope, 8) as slope, round(intercept, 6) as intercept from line")
def history_regression(spark: SparkSession, d: str) -> DataFrame:
    rows = history.regression(history.recent(_snapshots(spark, d)), "step", "loss")
    return rows.select("port", F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"))


def _to(t: float, name: str) -> str:
    return f"case when slope < 0 and loss > {t} and ({t} - intercept) / slope - step > 0 then trunc(({t} - intercept) / slope - step)::bigint end as {name}"


@query(f"""with {R} select port, n_points, greatest(10, n_points // 5) as window_size, round(slope, 8) as slope, round(intercept, 4) as intercept, round(slope * 1000, 4) as loss_per_1k,
  round(slope * (step + 1000) + intercept, 4) as loss_1000, round(slope * (step + 5000) + intercept, 4) as loss_5000, round(slope * (step + 10000) + intercept, 4) as loss_10000,
  {_to(1.0, 'steps_to_1_0')}, {_to(0.5, 'steps_to_0_5')}, {_to(0.1, 'steps_to_0_1')} from f join line using (port)""")
def history_trends(spark: SparkSession, d: str) -> DataFrame:
    return history.trends(_snapshots(spark, d))


@query(f"""with {R}, a as (select port, min_by(step, ord) as first, max_by(step, ord) as last from v group by port),
p as (select port, unnest([first, last, last + floor(0.2 * (last - first))::bigint]) as x, round(slope, 8) as a, round(intercept, 4) as b from a join line using (port))
select port, x, round(a * x + b, 4) as y from p""")
def history_trendline(spark: SparkSession, d: str) -> DataFrame:
    return history.trendline(_snapshots(spark, d))


@query(f"""with {S}, c as (select * from (select *, row_number() over (partition by port order by ord desc) as k from s) where k <= 40),
x as (select port, ord, loss, list(loss) filter (loss is not null) over (partition by port order by ord rows unbounded preceding) as ls from c)
select port, ord, case when loss is not null then round(list_reduce(ls, lambda a, b: 0.05 * b + 0.95 * a), 9) end as ema from x""")
def history_smoothed(spark: SparkSession, d: str) -> DataFrame:
    return history.smoothed(history.chart_rows(_snapshots(spark, d), 40), 0.05, 9)


@query(f"with {V} select port, round(list_reduce(list(loss order by ord), lambda a, b: 0.1 * b + 0.9 * a), 4) as ema from v group by port")
def history_latest_smoothed(spark: SparkSession, d: str) -> DataFrame:
    return history.latest_smoothed(_snapshots(spark, d))


@query(f"with {S} select port, min_by(step, ord) as first_step, max_by(step, ord) as last_step, arg_max_null(loss, ord) as last_loss, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_ts, count(*) as n from s group by port")
def history_run_summary(spark: SparkSession, d: str) -> DataFrame:
    out = history.run_summary(_snapshots(spark, d))
    return out.withColumn("first_ts", F.substring("first_ts", 1, 19))


@query(f"with {S}, p as (select distinct c_custkey % 200 as port from customer) select port, max_by(step, ord) as step, max_by(step, ord) is not null as reachable from p left join s using (port) group by port")
def history_status(spark: SparkSession, d: str) -> DataFrame:
    return history.status(table(spark, d, "customer").select((F.col("c_custkey") % 200).alias("port")).distinct(), _snapshots(spark, d))


@query("""select p_partkey, round(p_size * 1000.0::double / greatest(p_partkey % 90 * 1000, 1) * 100, 1) as mem_pct, (p_size * 60 // 60) || 'h ' || lpad((p_size % 60)::varchar, 2, '0') || 'm' as eta from part""")
def history_device_rows(spark: SparkSession, d: str) -> DataFrame:
    used = used_percent(F.col("p_size") * 1000, F.col("p_partkey") % 90 * 1000)
    return table(spark, d, "part").select("p_partkey", used.alias("mem_pct"), readable_eta(F.col("p_size") * 3600 + F.col("p_size") % 60 * 60).alias("eta"))


@query("select user_id as run, max(event_id % 81920) as peak_mib from events where event_id % 11 <> 0 group by 1")
def history_device_peak(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws(", ", F.lit("0"), F.when(F.col("event_id") % 11 == 0, F.lit("[N/A]")).otherwise((F.col("event_id") % 81920).cast("string")), F.lit("97"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("run"), F.trim(F.split(line, ",")[1]).try_cast("long").alias("mib"))
    return rows.groupBy("run").agg(F.max("mib").alias("peak_mib"))
