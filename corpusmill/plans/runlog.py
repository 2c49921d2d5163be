"""Run logs over ``events``: each user is a run; lines are rendered from the rows and read back, so the SQL works on the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.scalars import finite, label_path, readable_bytes, readable_share, short
from corpusmill.operators import runlog
from corpusmill.operators.scans import stored
from corpusmill.plans.registry import query
from corpusmill.sources import logs
from corpusmill.sources.tables import scratch_path, table

SEQ = 1024
# The same figures as ``_figures``, in SQL.
E = """e as (select 'run' || user_id as run, (row_number() over (partition by user_id order by event_id))::int as it, count(*) over (partition by user_id)::int as n,
  event_id, user_id, 500 + event_id * 37 % 1000 as ms, 2 + user_id % 3 as gbs, (10000 + event_id * 7919 % 20000) / 10000.0::double as loss,
  (event_id % 97 = 0)::int as skipped, (event_id % 101 = 0)::int as nans, 1000 + event_id * 13 % 5000 as mb from events)"""
HOT = "h as (select * from e where it >= 3)"
SUMMARY = f"""{E}, l as (select run, max_by(gbs, it) as gbs, max_by(loss, it) as final_loss, count(*) as n_steps, sum(skipped)::bigint as skipped, sum(nans)::bigint as nans from e group by run),
m as (select run, count(*) as hot_steps, avg(ms) as avg_ms, avg({SEQ} * gbs / (ms / 1000.0::double)) as tok_s_mean from (select e.run, e.ms, l.gbs from e join l using (run) where it >= 3) group by run),
s as (select run, n_steps, coalesce(hot_steps, 0) as hot_steps, round(avg_ms, 6) as avg_ms, (gbs * {SEQ})::bigint as tokens_per_step, round(tok_s_mean, 6) as tok_s_mean,
  round(gbs * {SEQ} / (avg_ms / 1000), 6) as tok_s_ratio, round(avg_ms / (gbs * {SEQ}), 12) as ms_per_token, final_loss, skipped, nans from l left join m using (run))"""


def _figures(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.concat(F.lit("run"), "user_id").alias("run"), "event_id", "user_id")
    return rows.selectExpr(
        "*", "row_number() over (partition by run order by event_id) as it", "count(*) over (partition by run) as n", "500 + event_id * 37 % 1000 as ms", "2 + user_id % 3 as gbs",
        "10000 + event_id * 7919 % 20000 as loss4", "cast(event_id % 97 = 0 as int) as skipped", "cast(event_id % 101 = 0 as int) as nans", "1000 + event_id * 13 % 5000 as mb",
    )


def _step_lines(spark: SparkSession, d: str) -> DataFrame:
    line = F.format_string(
        " iteration %8d/%8d | consumed samples: %12d | elapsed time per iteration (ms): %d.0 | throughput per GPU (TFLOP/s/GPU): %d.5 | global batch size: %5d | lm loss: %d.%04d | mtp_1 loss: %d.%04d | grad norm: %s | number of skipped iterations: %3d | number of nan iterations: %3d |",
        "it", "n", F.col("it") * F.col("gbs"), "ms", F.col("ms") % 300, "gbs", F.expr("loss4 div 10000"), F.col("loss4") % 10000, F.expr("(loss4 + 5000) div 10000"), (F.col("loss4") + 5000) % 10000,
        F.when(F.col("nans") == 1, "nan").otherwise("1.25"), "skipped", "nans",
    )
    return _figures(spark, d).select("run", F.col("it").alias("line_no"), line.alias("value"))


def _summary(spark: SparkSession, d: str) -> DataFrame:
    lines = _step_lines(spark, d)
    head = lines.select("run").distinct().select("run", F.lit(0).alias("line_no"), F.lit(f"  seq_length ................................ {SEQ}").alias("value"))
    return runlog.summary(runlog.steps(lines), runlog.seq_length(head))


def _memory_lines(spark: SparkSession, d: str) -> DataFrame:
    gib = F.format_string("[mem_profile] %s: alloc=%d.50 GiB reserved=%d.00 GiB max_alloc=%d.25 GiB max_reserved=%d.75 GiB", F.when(F.col("it") == 2, "setup").otherwise("step"), *[F.col("mb") % k for k in (50, 60, 70, 80)])
    mb = F.format_string("[Rank 0] (after 2 iterations) memory (MB) | allocated: %d.0 | max allocated: %d.0 | reserved: %d.0 | max reserved: %d.0", "mb", F.col("mb") + 10, F.col("mb") + 20, F.col("mb") + 30)
    return _figures(spark, d).select("run", F.col("it").alias("line_no"), F.when(F.col("it") % 2 == 0, gib).otherwise(mb).alias("value"))


MEMORY = f"""{E}, mem as (select run, it, case when it = 2 then 'setup' when it % 2 = 0 then 'step' else 'rank_memory' end as tag,
  case when it % 2 = 0 then mb % 50 + 0.5 else mb / 1024.0 end::double as alloc_gib, case when it % 2 = 0 then mb % 70 + 0.25 else (mb + 10) / 1024.0 end::double as max_alloc_gib from e)"""


@query(f"with {E} select run, it as iteration, n as total_iterations, (it * gbs)::bigint as consumed_samples, ms::double as elapsed_ms, gbs::int as global_batch_size, loss as lm_loss, skipped as skipped_iterations, nans as nan_iterations from e")
def runlog_steps(spark: SparkSession, d: str) -> DataFrame:
    return runlog.steps(_step_lines(spark, d)).drop("line_no", "value")


@query(f"with {E} select run, it as iteration, (ms % 300 + 0.5)::double as tflops, case when nans = 1 then 'nan' else '1.25' end as grad_norm from e")
def runlog_gpu_steps(spark: SparkSession, d: str) -> DataFrame:
    return runlog.gpu_steps(_step_lines(spark, d)).select("run", "iteration", "tflops", "grad_norm")


@query(f"with {E}, {HOT} select run, count(*) as n, round(avg(ms), 6) as avg_ms from h where it <= 10 group by run")
def runlog_hot_window(spark: SparkSession, d: str) -> DataFrame:
    rows = runlog.hot(runlog.steps(_step_lines(spark, d)), 3, 10)
    return rows.groupBy("run").agg(F.count("*").alias("n"), F.round(F.avg("elapsed_ms"), 6).alias("avg_ms"))


@query(f"with {SUMMARY} select * from s")
def runlog_summary(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d)


@query(f"with {E} select run, it as line_no, 'mtp_1' as name, loss + 0.5 as loss from e")
def runlog_extra_losses(spark: SparkSession, d: str) -> DataFrame:
    return runlog.extra_losses(_step_lines(spark, d)).withColumn("loss", F.round("loss", 4))


@query(f"with {MEMORY} select run, it as line_no, tag, round(alloc_gib, 6) as alloc_gib, round(max_alloc_gib, 6) as max_alloc_gib from mem")
def runlog_memory(spark: SparkSession, d: str) -> DataFrame:
    rows = runlog.memory(_memory_lines(spark, d))
    return rows.select("run", "line_no", "tag", F.round("alloc_gib", 6).alias("alloc_gib"), F.round("max_alloc_gib", 6).alias("max_alloc_gib"))


@query(f"with {MEMORY} select run, min_by(alloc_gib, it) filter (tag = 'setup') as setup_gib, round(max(max_alloc_gib), 6) as max_gib from mem group by run")
def runlog_memory_summary(spark: SparkSession, d: str) -> DataFrame:
    out = runlog.memory_summary(runlog.memory(_memory_lines(spark, d)), "setup")
    return out.withColumn("max_gib", F.round("max_gib", 6))


@query(f"""with {E}, c as (select run, case when event_id % 3 = 0 then 0 when event_id % 3 = 1 then 1 else 2 end as p, it, (1024 + event_id % 7)::int as v from e)
select run, min_by(v, p * 1000000000::bigint + it) as seq_length from c group by run""")
def runlog_seq_length(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("event_id") % 7 + 1024
    kinds = [F.format_string("  seq_length ........... %d", v), F.format_string("max_position_embeddings ..... %d  ", v), F.format_string("[local-quarter] go seq=%d", v)]
    text = F.when(F.col("event_id") % 3 == 0, kinds[0]).when(F.col("event_id") % 3 == 1, kinds[1]).otherwise(kinds[2])
    return runlog.seq_length(_figures(spark, d).select("run", F.col("it").alias("line_no"), text.alias("value")))


@query(f"""with {SUMMARY}, b as (select avg_ms as ba, tok_s_mean as bt from s where run = 'run0')
select run, round_even(avg_ms - ba, 6) as avg_ms_delta, round_even((avg_ms - ba) / ba * 100, 3) as avg_ms_pct, round_even(tok_s_mean - bt, 6) as tok_s_mean_delta, round_even((tok_s_mean - bt) / bt * 100, 3) as tok_s_mean_pct from s, b""")
def runlog_compare(spark: SparkSession, d: str) -> DataFrame:
    return runlog.against_baseline(_summary(spark, d), "run0", ["avg_ms", "tok_s_mean"])


STORAGE = f"""{E}, st as (select run, 'kind' || event_id % 4 as storage, max_by(1000 * it, it)::bigint as numel, max_by(it * 1073741824::bigint, it)::bigint as bytes from e where it between 2 and 5 group by all)"""


def _storage(spark: SparkSession, d: str) -> DataFrame:
    line = F.format_string("[mem_profile]   kind%d   %,d elems   %d.000 GiB", F.col("event_id") % 4, F.col("it") * 1000, "it")
    text = F.when(F.col("it") == 1, "[mem_profile] by_storage:").when(F.col("it") == 6, "[mem_profile] top_parameters:").otherwise(line)
    return runlog.storage(_figures(spark, d).select("run", F.col("it").alias("line_no"), text.alias("value")))


@query(f"with {STORAGE} select * from st")
def runlog_storage(spark: SparkSession, d: str) -> DataFrame:
    return _storage(spark, d)


@query(f"""with {STORAGE} select coalesce(a.storage, b.storage) as storage, a.bytes as left_value, b.bytes as right_value
from (select * from st where run = 'run0') a full join (select * from st where run = 'run1') b using (storage)""")
def runlog_side_by_side(spark: SparkSession, d: str) -> DataFrame:
    return runlog.side_by_side(_storage(spark, d), "run0", "run1", "storage", "bytes")


@query(f"""with {SUMMARY} select run, unnest(list_filter([case when hot_steps < 2 then 'fewer than two steady steps' end, case when skipped > 0 then skipped || ' skipped iterations' end,
  case when nans > 0 then nans || ' nan iterations' end], lambda x: x is not null)) as warning from s""")
def runlog_warnings(spark: SparkSession, d: str) -> DataFrame:
    return runlog.warnings(_summary(spark, d))


@query(f"""with {SUMMARY}, w as (select unnest(list_filter([case when skipped > 0 then skipped || ' skipped iterations' end, case when nans > 0 then nans || ' nan iterations' end,
  case when hot_steps < 2 then 'fewer than two steady steps' end], lambda x: x is not null)) as warning from s) select distinct warning from w""")
def runlog_warning_union(spark: SparkSession, d: str) -> DataFrame:
    return runlog.warnings(_summary(spark, d)).select("warning").distinct()


@query("""select 'u' || user_id as label from events except select 'u' || c_custkey from customer where c_custkey % 2 = 1""")
def runlog_orphans(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "events").select(F.concat(F.lit("u"), "user_id").alias("label"))
    known = table(spark, d, "customer").filter("c_custkey % 2 = 1").select(F.concat(F.lit("u"), "c_custkey").alias("label"))
    return runlog.orphans(named, known, "label")


@query("""select o_custkey as run, min(o_orderkey) as first_key, min_by(o_orderpriority, o_orderkey) as priority from orders group by o_custkey""")
def runlog_first_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = runlog.first_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"])
    return rows.select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("first_key"), F.col("o_orderpriority").alias("priority"))


@query("""with live as (select user_id as port, count(*) as n from events where user_id % 2 = 0 group by 1), p as (select distinct user_id as port from events)
select port, n, true as reachable from live union all select port, null, false from p where port not in (select port from live)""")
def runlog_with_missing(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumnRenamed("user_id", "port")
    return runlog.with_missing(events.filter("port % 2 = 0").groupBy("port").agg(F.count("*").alias("n")), events.select("port").distinct(), "port")


@query("""with f as (select 'run' || user_id as run, unnest(['out_' || event_id % 5 || '.' || case event_id % 3 when 0 then 'csv' when 1 then 'txt' else 'json' end]) as path from events), g as (select distinct run, path from f)
select run, split_part(path, '.', 2) as kind, count(*) as n_paths, string_agg(path, ',' order by path) as paths from g group by 1, 2""")
def runlog_artifacts(spark: SparkSession, d: str) -> DataFrame:
    kind = F.expr("case event_id % 3 when 0 then 'csv' when 1 then 'txt' else 'json' end")
    text = F.format_string("saved trace to %s (ok)", F.concat(F.lit("out_"), F.col("event_id") % 5, F.lit("."), kind))
    lines = _figures(spark, d).select("run", F.col("it").alias("line_no"), text.alias("value"))
    return runlog.artifacts(lines, r"(\w+\.(?:csv|txt|json))")


@query("""select o_orderpriority as label, 'p' || o_orderkey as path from orders where o_orderkey % 3 <> 0 and o_orderkey % 5 <> 0""")
def runlog_label_paths(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("case when o_orderkey % 3 = 0 then o_orderpriority when o_orderkey % 5 = 0 then concat('=p', o_orderkey) else concat(o_orderpriority, '=p', o_orderkey) end")
    return table(spark, d, "orders").select(label_path(text).alias("p")).filter("p is not null").select("p.label", "p.path")


@query("select o_custkey as label, count(*) as n from orders group by 1 having count(*) > 1")
def runlog_repeated_labels(spark: SparkSession, d: str) -> DataFrame:
    return runlog.repeated_labels(table(spark, d, "orders").withColumnRenamed("o_custkey", "label"), "label")


@query(f"with {E}, r as (select run, it, row_number() over (partition by run order by it desc) as k from e) select run, it as line_no from r where k <= 5")
def runlog_tail(spark: SparkSession, d: str) -> DataFrame:
    return logs.tail_per_run(_step_lines(spark, d), 5).select("run", "line_no")


@query("""select p_partkey, case when floor(p_retailprice) * 1e9 / 1e12 >= 0.1 then printf('%.3f TB', floor(p_retailprice) * 1e9 / 1e12) when floor(p_retailprice) * 1e9 / 1e9 >= 0.1 then printf('%.3f GB', floor(p_retailprice) * 1e9 / 1e9) end as size,
  case when length(p_name) <= 12 then p_name else substr(p_name, 1, 9) || '...' end as name from part""")
def runlog_formats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", readable_bytes(F.floor("p_retailprice") * 1e9).alias("size"), short(F.col("p_name"), 12).alias("name"))


@query("select 'prof' || c_custkey % 7 as prefix, '202604' || lpad((10 + c_custkey % 20)::varchar, 2, '0') as date, count(*) as n from customer group by 1, 2")
def runlog_profile_groups(spark: SparkSession, d: str) -> DataFrame:
    stem = F.expr("concat('prof', c_custkey % 7, '_202604', lpad(cast(10 + c_custkey % 20 as string), 2, '0'), '_x')")
    return table(spark, d, "customer").select(runlog.profile_group(stem).alias("g")).groupBy("g.prefix", "g.date").agg(F.count("*").alias("n"))


@query("""with l as (select o_orderstatus as part, o_orderkey, row_number() over (partition by o_orderstatus order by o_orderkey) as k from orders)
select part, count(*) as n, sum(o_orderkey)::bigint as keys, sum((2 * k - 2) * o_orderkey)::bigint as placed from l group by part""")
def runlog_files(spark: SparkSession, d: str) -> DataFrame:
    # One log file of each order status, an empty line after every line.
    path = scratch_path(spark, "log-files")
    rows = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", F.concat_ws(" ", F.lit("order"), "o_orderkey", "o_orderstatus", F.lit("\n")).alias("value"))
    rows.repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey").select("o_orderstatus", "value").write.partitionBy("o_orderstatus").text(path)
    lines = logs.log_lines(spark, f"{path}/*")
    words = F.split("value", " ")
    found = lines.select(words[2].alias("part"), words[1].cast("long").alias("o_orderkey"), "line_no")
    placed = F.sum((F.col("line_no") * F.col("o_orderkey")).cast("decimal(20,0)")).cast("decimal(38,0)")
    sums = stored(found.groupBy("part").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), placed.alias("placed")), "log-sums")
    # ``placed`` grows with the third power of the orders.  Beyond a bigint, where the SQL has no result, it stays a whole decimal.
    return sums if sums.filter(F.col("placed").try_cast("long").isNull()).head(1) else sums.withColumn("placed", F.col("placed").cast("long"))


@query("""select p_partkey, case when p_partkey % 5 in (1, 2) then null else round_even(p_retailprice / 7, 3) end as value, case when p_size % 10 = 0 then '-' else printf('%.1f%%', p_size % 10 * 4.0) end as mfu from part""")
def runlog_finite(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("case p_partkey % 5 when 1 then double('NaN') when 2 then double('-Infinity') else p_retailprice / 7 end")
    share = F.expr("if(p_size % 20 = 0, null, p_size % 10 * 0.04D)")
    return table(spark, d, "part").select("p_partkey", finite(value, 3).alias("value"), readable_share(share).alias("mfu"))


@query("""with n as (select distinct 'run' || user_id as run, 'out_' || event_id % 5 || '.' || case event_id % 3 when 0 then 'csv' when 1 then 'txt' else 'json' end as path from events where user_id % 4 <> 0 or event_id % 3 = 0),
k as (select *, split_part(path, '.', 2) as kind from n), r as (select distinct run from k), x as (select run, kind from r, (select unnest(['csv', 'json', 'pdf']) as kind))
select run, count(*) || ' artifacts do not exist' as warning from k where path like 'out_3%' group by run union all select run, 'no ' || kind || ' found' from x where (run, kind) not in (select (run, kind) from k)""")
def runlog_artifact_warnings(spark: SparkSession, d: str) -> DataFrame:
    kind = F.expr("case event_id % 3 when 0 then 'csv' when 1 then 'txt' else 'json' end")
    events = table(spark, d, "events").filter("user_id % 4 <> 0 or event_id % 3 = 0")
    named = events.select(F.concat(F.lit("run"), "user_id").alias("run"), F.concat(F.lit("out_"), F.col("event_id") % 5, F.lit("."), kind).alias("path"), kind.alias("kind")).distinct()
    return runlog.artifact_warnings(named, named.filter("path not like 'out_3%'"), ("csv", "json", "pdf"))


@query(f"with {SUMMARY} select run, 'log says ' || tokens_per_step || ' tokens a step, profile ' || 3 * {SEQ} as warning from s where tokens_per_step <> 3 * {SEQ}")
def runlog_token_warnings(spark: SparkSession, d: str) -> DataFrame:
    rows = _summary(spark, d)
    return runlog.token_warnings(rows, rows.select("run", F.lit(3).alias("batch"), F.lit(SEQ).alias("length")))


@query("select 'run' || user_id as run, 'two profilers in one run' as warning from events where event_id % 500 = 7 group by user_id")
def runlog_profiler_clash(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 500 == 7, F.concat(F.lit("warning: "), F.lit(runlog.CUPTI))).otherwise("fine")
    return runlog.log_warnings(table(spark, d, "events").select(F.concat(F.lit("run"), "user_id").alias("run"), text.alias("value")))
