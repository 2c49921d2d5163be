"""Audits over ``part``, ``lineitem``, ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import audit
from corpusmill.plans.registry import query
from corpusmill.sources.tables import table

P = """p as (select p_partkey, ['layers.0.A_log', 'layers.1.weight', 'embed.weight', 'out.bias', 'x.dt_bias'][p_partkey % 5 + 1] as name, p_brand, p_type, p_size % 3 as dims, (p_partkey * 64)::bigint as numel,
  (p_partkey * 64 * case when p_size % 2 = 0 then 2 else 4 end)::bigint as bytes, case when p_size % 2 = 0 then 'bf16' else 'fp32' end as dtype from part),
c as (select *, case when name like '%A_log' or name like '%dt_bias' then 'mamba_scalar_bc' when name like 'embed%' then 'scalar_fallback_embedding_or_output' when p_partkey % 7 = 0 then 'scalar_fallback_tagged'
  when dims <> 2 then 'scalar_fallback_non_2d' else 'muon_matrix' end as category from p)"""
B = f"""{P}, b as (select 'by_category' as section, category as key, count(*) as n, sum(numel)::bigint as numel, sum(bytes)::bigint as bytes from c group by 2
union all select 'by_dtype', dtype, count(*), sum(numel)::bigint, sum(bytes)::bigint from c group by 2 union all select 'by_both', category || '|' || dtype || '|' || p_brand, count(*), sum(numel)::bigint, sum(bytes)::bigint from c group by 2)"""


def _parameters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr(
        "p_partkey", "array('layers.0.A_log', 'layers.1.weight', 'embed.weight', 'out.bias', 'x.dt_bias')[p_partkey % 5] as name", "p_brand", "p_size % 3 as dims", "p_partkey * 64 as numel",
        "p_partkey * 64 * if(p_size % 2 = 0, 2, 4) as bytes", "if(p_size % 2 = 0, 'bf16', 'fp32') as dtype",
    )
    return rows.withColumn("category", audit.parameter_category(F.col("name"), F.col("name").startswith("embed"), F.col("p_partkey") % 7 == 0, F.col("dims")))


def _buckets(spark: SparkSession, d: str) -> DataFrame:
    return audit.buckets(_parameters(spark, d), {"by_category": ["category"], "by_dtype": ["dtype"], "by_both": ["category", "dtype", "p_brand"]}, "numel", "bytes")


@query(f"with {B} select * from b")
def audit_buckets(spark: SparkSession, d: str) -> DataFrame:
    return _buckets(spark, d)


@query(f"with {B} select * from (select *, row_number() over (partition by section order by bytes desc, key)::int as rank from b) where rank <= 5")
def audit_heaviest(spark: SparkSession, d: str) -> DataFrame:
    return audit.heaviest_per_section(_buckets(spark, d), 5)


@query("""with f as (select *, row_number() over (partition by l_suppkey, l_partkey order by l_orderkey * 10 + l_linenumber, l_quantity::bigint) as k from lineitem)
select l_suppkey as device, sum(case when k = 1 then l_quantity::bigint else 0 end)::bigint as counted, sum(l_quantity::bigint)::bigint as named from f group by 1""")
def audit_distinct_storage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_quantity").cast("long").alias("bytes"))
    out = audit.distinct_storage(rows, ["l_suppkey", "l_partkey"], "ord", "bytes")
    return out.groupBy(F.col("l_suppkey").alias("device")).agg(F.sum("counted").alias("counted"), F.sum("bytes").alias("named"))


@query("""with s as (select l_quantity::bigint * l_partkey * 1000 as size from lineitem where l_returnflag <> 'R')
select case when size > 104857600 then '>100MB' when size > 10485760 then '>10MB' when size > 1048576 then '>1MB' else '<1MB' end as bucket, count(*) as n, sum(size)::bigint as bytes from s group by 1""")
def audit_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "lineitem").selectExpr("if(l_returnflag = 'R', 'inactive', 'active_allocated') as state", "cast(l_quantity as bigint) * l_partkey * 1000 as size")
    return audit.size_histogram(blocks)


#: Events in a total order; rows tied in it are equal in all that is used of them.
EVENTS = "l_orderkey, l_linenumber, l_partkey, l_returnflag, cast(l_quantity as bigint)"


@query(f"""with recursive own as (select l_suppkey as device, row_number() over (partition by l_suppkey order by {EVENTS}) as idx, l_returnflag = 'R' as freed, l_quantity::bigint as size, l_partkey % 8 as addr from lineitem),
was as (select *, lag(freed) over before as was_freed, lag(size) over before as was_size from own window before as (partition by device, addr order by idx)),
ev as (select device, idx, case when freed then -1 else 1 end as sgn, case when freed and addr <> 0 and not was_freed then was_size else size end as size from was),
walk as (select device, 0::bigint as idx, 0::bigint as live, 0::bigint as peak, -1::bigint as peak_idx from (select distinct device from ev)
  union all select e.device, e.idx, greatest(w.live + e.sgn * e.size, 0), case when e.sgn = 1 and w.live + e.size > w.peak then w.live + e.size else w.peak end, case when e.sgn = 1 and w.live + e.size > w.peak then e.idx else w.peak_idx end
  from walk w join ev e on e.device = w.device and e.idx = w.idx + 1)
select device, max_by(peak, idx) as peak, max_by(peak_idx, idx) as peak_idx, max_by(live, idx) as live_end from walk group by device""")
def audit_replay(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr(
        "l_suppkey as device", "if(l_returnflag = 'R', 'free_completed', 'alloc') as action", "cast(l_quantity as bigint) as size", "l_partkey % 8 as addr",
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
    )
    return audit.replay(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "size"])


@query("""with l as (select user_id as run, event_id, 'direct_hits' as key, case when event_id % 50 = 7 then 1 else 0 end as pr, case when event_id % 50 = 7 then event_id * 3 else event_id end as v from events)
select run, key, max_by(v, pr * 1000000000 + event_id) as value from l group by all union all select user_id, 'copies', max_by(event_id % 17, event_id) from events where event_id % 50 <> 7 group by 1""")
def audit_last_counters(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("if(event_id % 50 = 7, concat('final direct_hits = ', event_id * 3, ' ok'), concat('x TE stats: {\\'direct_hits\\': ', event_id, ', \\'copies\\': ', event_id % 17, '}'))")
    lines = table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("line_no"), text.alias("value"))
    return audit.last_counters(lines, "TE stats:", ("direct_hits", "copies"))


@query("""select l_suppkey as run, max(case l_linenumber % 3 when 0 then l_partkey * 1073741824 when 1 then l_partkey * 1048576 else l_partkey end)::bigint as max_bytes from lineitem group by 1""")
def audit_max_bytes(spark: SparkSession, d: str) -> DataFrame:
    return audit.max_bytes(table(spark, d, "lineitem").selectExpr("l_suppkey as run", "l_partkey as value", "array('GiB', 'MB', 'B')[l_linenumber % 3] as unit"))


@query("""with g as (select o_custkey as run, count(distinct o_orderkey % 2 + 1) as n_sizes, min(o_orderkey % 2 + 1) as size from orders group by 1), d as (select c_custkey as run, c_nationkey as declared from customer)
select coalesce(d.run, g.run) as run, coalesce(n_sizes, 0) as n_sizes, case when n_sizes = 1 then size else declared end as used from d full join g on d.run = g.run""")
def audit_inferred_experts(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "orders").selectExpr("o_custkey as run", "o_orderkey % 2 + 1 as size")
    return audit.inferred_experts(table(spark, d, "customer").selectExpr("c_custkey as run", "c_nationkey as declared"), groups)


@query("select p_partkey, greatest(p_partkey * 10 - p_size * 40 - 100, 0)::bigint as other from part")
def audit_residual(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", audit.residual(F.col("p_partkey") * 10, F.col("p_size") * 40, F.lit(100)).alias("other"))


@query("""with m as (select user_id as run, 'loss' as metric, round(avg(value), 4) as v from events group by 1 union all select user_id, 'n', count(*) from events where user_id % 4 <> 0 group by 1), r as (select distinct run from m),
l as (select * from (values ('loss', '<=', 55.0), ('n', '>=', 60.0)) t(metric, op, bound)), w as (select r.run, l.*, m.v from r cross join l left join m on m.run = r.run and m.metric = l.metric)
select run, metric, case when v is null then 'missing' else 'not ' || op || ' bound' end as problem from w where v is null or (op = '>=' and v < bound) or (op = '<=' and v > bound)""")
def audit_threshold_errors(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    loss = events.groupBy(F.col("user_id").alias("run")).agg(F.round(F.avg("value"), 4).alias("value")).withColumn("metric", F.lit("loss"))
    n = events.filter("user_id % 4 <> 0").groupBy(F.col("user_id").alias("run")).agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("n"))
    limits = spark.createDataFrame([("loss", "<=", 55.0), ("n", ">=", 60.0)], "metric string, op string, bound double")
    return audit.threshold_errors(loss.unionByName(n), limits)


@query("""with c as (select event_id as run, (props::json ->> 'k')::bigint as k from events)
select run, 'k not zero' as problem from c where k <> 0 union all select run, 'j missing' from c union all select run, 'no work counted' from c where not coalesce(k, 0) > 0 union all select run, 'k missing' from c where k is null""")
def audit_counter_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_id").alias("run"), F.from_json("props", "map<string,bigint>").alias("counters"))
    return audit.counter_errors(rows, ("k", "j"), ("k",))


@query("""select p_partkey as run, p_size % 3 <> 0 and p_partkey % 4 <> 0 as ready, concat_ws(',', case when p_size % 3 = 0 then 'counters' end, case when p_partkey % 4 = 0 then 'peak' end) as missing from part""")
def audit_readiness(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey as run", "if(p_size % 3 = 0, null, p_size) as counters", "if(p_partkey % 4 = 0, null, p_partkey) as peak")
    return audit.readiness(rows, ["counters", "peak"])


@query("""with r as (select user_id::varchar as name, value as ms, row_number() over (partition by user_id order by value) - 1 as k, count(*) over (partition by user_id) as c from events)
select name, count(*) as n, round(round(avg(ms), 9), 6) as mean, max(case when k = c // 2 then ms end) as p50, max(case when k = floor(c * 0.99)::bigint then ms end) as p99, round(median(ms), 6) as median, round(round(stddev_pop(ms), 9), 6) as stdev from r group by name""")
def audit_bench_stats(spark: SparkSession, d: str) -> DataFrame:
    return audit.bench_stats(table(spark, d, "events").select(F.col("user_id").cast("string").alias("name"), F.col("value").alias("ms")))


L = """l as (select 'c' || user_id as run, (row_number() over (partition by user_id order by event_id))::int as it, event_id, user_id, value from events)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").selectExpr("concat('c', user_id) as run", "row_number() over (partition by user_id order by event_id) as line_no", "event_id", "user_id")
    text = F.expr("""case when user_id % 11 = 3 and line_no = 35 then concat('torch.OutOfMemoryError: CUDA out of memory peak_alloc_gib=', line_no, '.5')
      when user_id % 11 = 5 and line_no = 20 then 'RuntimeError: x' when user_id % 11 = 7 and line_no >= 25 then 'stopped'
      else concat(' iteration ', line_no, '/ 60 | elapsed time per iteration (ms): ', 100 + event_id % 50, '.0 | throughput 1 | lm loss: ', 1 + event_id % 9, '.5 | grad norm: ', if(event_id % 151 = 0, 'nan', '1.0'), ' | peak_alloc_gib=', event_id % 40, '.25') end""")
    return rows.select("run", "line_no", text.alias("value"))


@query(f"""with {L}, k as (select *, (user_id % 11 = 3 and it = 35) or (user_id % 11 = 5 and it = 20) or (user_id % 11 = 7 and it >= 25) as odd from l)
select run, count(case when not odd and event_id % 151 <> 0 then 1 end) as finite, count(case when not odd and event_id % 151 = 0 then 1 end) as nan, count(case when not odd then 1 end) as total,
  case when count(case when not odd and event_id % 151 = 0 then 1 end) > 0 then 'bad' when count(case when not odd then 1 end) > 0 then 'good' else 'unknown' end as verdict from k group by run""")
def audit_gradient_verdict(spark: SparkSession, d: str) -> DataFrame:
    return audit.gradient_verdict(_lines(spark, d))


SWEEP = f"""{L}, k as (select *, (user_id % 11 = 3 and it = 35) or (user_id % 11 = 5 and it = 20) or (user_id % 11 = 7 and it >= 25) as odd from l),
f as (select run, user_id, bool_or(user_id % 11 = 3 and it = 35) as oom, bool_or(user_id % 11 = 5 and it = 20) as crash, min_by(case when odd then it + 0.5 else event_id % 40 + 0.25 end, it) as fp, max(case when not odd then event_id % 40 + 0.25 end) as mp,
  round(avg(case when not odd and it between 30 and 50 then 100 + event_id % 50 end), 1) as ms, max(case when not odd and it = 50 then 1.5 + event_id % 9 end) as loss from k group by 1, 2),
s as (select config, case when run is null then 'NO_LOG' when oom then 'OOM' when crash then 'CRASH' when ms is null then 'NO_ITER_DATA' else 'OK' end as status, f.* from (select 'c' || c_custkey as config from customer) left join f on config = run)"""


def _sweep(spark: SparkSession, d: str) -> DataFrame:
    configs = table(spark, d, "customer").selectExpr("concat('c', c_custkey) as config", "64 as gbs")
    return audit.sweep_status(configs, _lines(spark, d))


@query(f"""with {SWEEP} select config, case when status = 'OK' then ms end as iter_ms, case when status = 'OK' then round(64 * 4096 * 1000 / ms) end as tok_sec, (case when status = 'OK' then mp when status = 'OOM' then fp end)::double as peak_gb,
  (case when status = 'OK' then loss end)::double as loss, status from s""")
def audit_sweep_status(spark: SparkSession, d: str) -> DataFrame:
    return _sweep(spark, d)


@query(f"with {SWEEP} select case when status in ('OK', 'OOM') then status else 'crash' end as status, count(*) as n from s group by 1")
def audit_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.status_counts(_sweep(spark, d), ("OK", "OOM"))


@query("""with r as (select user_id as run, value, row_number() over (partition by user_id order by event_id desc) as k from events) select run, count(*) as n, round(avg(value), 6) as mean_ms from r where k <= 20 group by run""")
def audit_last_n_mean(spark: SparkSession, d: str) -> DataFrame:
    return audit.last_n_mean(table(spark, d, "events").selectExpr("user_id as run", "event_id as it", "value as ms"), 20)


@query(f"""with {L}, k as (select *, (user_id % 11 = 3 and it = 35) or (user_id % 11 = 5 and it = 20) or (user_id % 11 = 7 and it >= 25) as odd from l),
f as (select run, max(case when not odd and event_id % 151 = 0 then it end) as nan_iter, max_by(case when event_id % 151 = 0 then 'nan' else '1.0' end, it) filter (not odd) as last_grad from k group by run),
e as (select 'c' || c_custkey as run, case c_custkey % 5 when 1 then 1 when 2 then 124 else 0 end as x from customer)
select run, nan_iter, last_grad, case when x = 124 then 'timeout' when nan_iter is not null then 'nan' when x = 0 then 'finite' else 'crash' end as status from e left join f using (run)""")
def audit_nan_sweep(spark: SparkSession, d: str) -> DataFrame:
    exits = table(spark, d, "customer").selectExpr("concat('c', c_custkey) as run", "case c_custkey % 5 when 1 then 1 when 2 then 124 else 0 end as exit_code")
    return audit.nan_sweep(_lines(spark, d), exits)


@query(f"""with {P}, a as (select p_brand as prefix, dtype, count(*) as tensors, sum(numel)::bigint as elems from c group by 1, 2) select *, bool_or(dtype <> 'fp32') over (partition by prefix) as prefix_mixed from a""")
def audit_dtypes(spark: SparkSession, d: str) -> DataFrame:
    return audit.dtype_audit(_parameters(spark, d).select(F.col("p_brand").alias("prefix"), "dtype", F.col("numel").alias("elems")), "fp32")


@query("""with p as (select l_returnflag as grp, abs(l_extendedprice * (1 + l_tax / 100) - l_extendedprice) as d, l_extendedprice as e from lineitem)
select grp, round(max(d), 6) as max_abs, round(avg(d), 6) as mean_abs, round(max(d / (abs(e) + 1e-8)), 6) as max_rel, round(avg(d / (abs(e) + 1e-8)), 6) as mean_rel, count(case when d / (abs(e) + 1e-8) > 0.0003 then 1 end) as n_above,
  round(100.0 * count(case when d / (abs(e) + 1e-8) > 0.0003 then 1 end) / count(*), 4) as pct_above, round(sqrt(sum(d * d) / sum(e * e)), 6) as rel_l2 from p group by grp""")
def audit_errors(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "lineitem").selectExpr("l_returnflag as grp", "l_extendedprice * (1 + l_tax / 100) as actual", "l_extendedprice as expected")
    return audit.errors(pairs, limit=0.0003)


@query("""with b as (select unnest(range(8)) as bin), c as (select least(l_partkey % 300 // 32, 7) as bin, count(*) as n from lineitem where l_partkey % 300 < 256 group by 1) select bin, coalesce(n, 0) as n, round(100.0 * coalesce(n, 0) / 32, 4) as pct from b left join c using (bin)""")
def audit_position_histogram(spark: SparkSession, d: str) -> DataFrame:
    return audit.position_histogram(table(spark, d, "lineitem").selectExpr("l_partkey % 300 as pos").filter("pos < 256"), 256)


@query("""with p as (select unnest(range(500)) as pos), c as (select l_partkey % 500 as pos, count(*) as n from lineitem group by 1) select pos, coalesce(n, 0) as n from p left join c using (pos)""")
def audit_reference_counts(spark: SparkSession, d: str) -> DataFrame:
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey") % 500).alias("idx"))
    return audit.reference_counts(lists, 500)


@query("""with e as (select l_partkey % 500 as pos, max(l_discount) as err, count(*) as n from lineitem group by 1) select round(corr(n, err), 6) as r from e""")
def audit_reference_correlation(spark: SparkSession, d: str) -> DataFrame:
    each = table(spark, d, "lineitem").groupBy(F.col("l_partkey") % 500).agg(F.max("l_discount").alias("err"), F.count("*").alias("n"))
    return audit.correlation(each, "n", "err").select(F.round("r", 6).alias("r"))


@query("""with e as (select l_partkey % 500 as pos, max(l_extendedprice) as err, count(*) as n from lineitem group by 1) select pos, err, n from e order by err desc, pos limit 20""")
def audit_worst_positions(spark: SparkSession, d: str) -> DataFrame:
    each = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 500).alias("pos")).agg(F.max("l_extendedprice").alias("err"), F.count("*").alias("n"))
    return each.orderBy(F.desc("err"), "pos").limit(20)


@query("""select case when l_partkey % 500 < 256 then 'boundary' else 'interior' end as part, count(*) as n, round(avg(l_discount), 6) as mean_err, max(l_discount) as max_err from lineitem group by 1""")
def audit_boundary(spark: SparkSession, d: str) -> DataFrame:
    return audit.boundary_stats(table(spark, d, "lineitem").selectExpr("l_partkey % 500 as pos", "l_discount as err"), 256)


@query("select l_returnflag as grp, quantile_disc(l_extendedprice, 0.5) as lower_median from lineitem group by 1")
def audit_lower_median(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp"), "l_extendedprice")
    return audit.lower_median(rows, "grp", "l_extendedprice")



@query("""with m as (select p_brand as name, round(avg(p_retailprice), 6) as ms from part group by 1), b as (select ms as base from m order by name limit 1) select name, ms, round(base / ms, 6) as speedup from m, b""")
def audit_speedups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.round(F.avg("p_retailprice"), 6).alias("ms"))
    return audit.speedups(rows, rows.agg(F.min("name")).first()[0])


@query(f"""with {P}, s as (select category, sum(bytes)::bigint as total from c group by 1 having sum(bytes) > 0) select category, total, round(100 * total / greatest(sum(total) over (), 1), 4) as pct from s""")
def audit_shares(spark: SparkSession, d: str) -> DataFrame:
    return audit.shares(_parameters(spark, d), "category", "bytes")


@query(f"""with {P} select name, sum(numel * 2)::bigint as model_bytes, sum(numel * 4)::bigint as grad_bytes, sum(case when category like 'scalar%' then numel * 12 else numel + (numel + 255) // 256 * 4 end)::bigint as state_bytes from c group by name""")
def audit_state_bytes(spark: SparkSession, d: str) -> DataFrame:
    rows = audit.state_bytes(_parameters(spark, d).select("name", "numel", F.col("category").startswith("scalar").alias("is_fallback")))
    return rows.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("model_bytes", "grad_bytes", "state_bytes")])


@query("""with f as (select p_partkey, case p_partkey % 6 when 0 then ['torch/_dynamo/x.py', 'VariableType_0.cpp'] when 1 then [p_brand] when 2 then ['torch/autograd/f.py', '??'] else [p_type, p_brand] end as fr from part)
select p_partkey, array_to_string(fr[1:2], ';') as frames from f""")
def audit_frames(spark: SparkSession, d: str) -> DataFrame:
    frames = F.expr("""case p_partkey % 6 when 0 then array('torch/_dynamo/x.py', 'VariableType_0.cpp') when 1 then array('', '??', p_brand, 'torch/_inductor/a.py')
      when 2 then array('torch/autograd/f.py', '??') else array(p_type, 'torch/_dynamo/x.py', '', p_brand, 'torch/autograd/g.py') end""")
    return table(spark, d, "part").select("p_partkey", F.array_join(audit.useful_frames(frames, 2), ";").alias("frames"))


NAMES = "['decoder.layers.1.MLP.experts.2.w', 'mtp.0.self_attention.q', 'embedding.word_embeddings.weight', 'layers.3.mixer.A', 'final_layernorm.weight', 'x.router.weight', 'layers.1.mlp.fc1', 'ngram_table', 'bias']"


@query(f"""with n as (select {NAMES}[p_partkey % 9 + 1] as name from part) select case lower(name) when 'decoder.layers.1.mlp.experts.2.w' then 'moe_experts' when 'mtp.0.self_attention.q' then 'mtp'
  when 'embedding.word_embeddings.weight' then 'embedding' when 'layers.3.mixer.a' then 'mamba_mixer' when 'final_layernorm.weight' then 'norm' when 'x.router.weight' then 'moe_router' when 'layers.1.mlp.fc1' then 'dense_mlp'
  when 'ngram_table' then 'ngram_hash' else 'other' end as grp, count(*) as n from n group by 1""")
def audit_parameter_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.expr(f"array({NAMES[1:-1]})[p_partkey % 9]").alias("name"))
    return rows.groupBy(audit.parameter_group(F.col("name")).alias("grp")).agg(F.count("*").alias("n"))


@query("""with c as (select c_custkey as run, c_custkey % 4 as g, c_nationkey as ad, c_custkey % 9 as aw, case when c_custkey % 5 <> 0 then c_custkey % 40 end as total from customer),
e as (select o_custkey as run, sum(case when o_orderkey % 2 = 0 then 1 else 0 end) as ed, sum(case when o_orderkey % 2 = 1 then 1 else 0 end) as ew, sum(case when o_orderkey % 2 = 0 then o_orderkey % 3 else 0 end) as cd,
  sum(case when o_orderkey % 2 = 1 then o_orderkey % 3 + o_orderkey % 5 else 0 end) as cw, count(distinct 8 + o_custkey % 2) as k, min(8 + o_custkey % 2) as size from orders group by 1),
r as (select c.*, e.run is not null as counted, coalesce(ed, g) as gd, coalesce(ew, 0) as gw, coalesce(cd, g * 16) as cd, coalesce(cw, 0) as cw from c left join e using (run)),
w as (select *, greatest(ad - gd, 0) as dd, greatest(aw - gw, 0) as dw, cd + cw as grouped from r)
select run, total, grouped::bigint as grouped_copies, (case when total is null then dd + 2 * dw else greatest(total - grouped, 0) end)::bigint as dense_copies, (gd + gw)::bigint as grouped_hits, (dd + dw)::bigint as dense_hits,
  (total - grouped - (dd + 2 * dw))::bigint as unattributed, case when counted then 'counted' else 'inferred' end as source from w""")
def audit_copy_breakdown(spark: SparkSession, d: str) -> DataFrame:
    counted = F.expr("""map_filter(map('mxfp8_grouped_transpose_copy_fallback_dgrad', c_custkey % 4, 'mxfp8_tn_adapter_dgrad', cast(c_nationkey as bigint), 'mxfp8_tn_adapter_wgrad', c_custkey % 9,
      'mxfp8_tn_adapter_copy_transpose', if(c_custkey % 5 <> 0, c_custkey % 40, null)), (k, v) -> v is not null)""")
    counters = table(spark, d, "customer").select(F.col("c_custkey").alias("run"), counted.alias("counters"))
    events = table(spark, d, "orders").selectExpr(
        "o_custkey as run", "if(o_orderkey % 2 = 0, 'dgrad', 'wgrad') as kind", "o_orderkey % 3 as converted_a", "8 + o_custkey % 2 as total_a", "if(o_orderkey % 2 = 0, 0, o_orderkey % 5) as converted_b", "0L as total_b",
    )
    return audit.copy_breakdown(counters, events, counters.select("run", F.lit(16).alias("declared")))


@query("""with e as (select 'world' as parent, r_name as child from region union all select r_name, n_name from nation join region on n_regionkey = r_regionkey)
select 'world' as node, 0 as depth union all select child, 1 from e where parent = 'world' union all select child, 2 from e where parent <> 'world'""")
def audit_descendants(spark: SparkSession, d: str) -> DataFrame:
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    edges = region.select(F.lit("world").alias("parent"), F.col("r_name").alias("child")).unionByName(
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    )
    return audit.descendants(edges, "world")


@query("""with recursive e as (select 'c' || c_custkey as parent, 'c' || c_custkey // 2 as child from customer union all select 'c0', 'c' || max(c_custkey) from customer), top as (select 'c' || max(c_custkey) as node from customer),
walk as (select node, 0 as depth from top union select child, depth + 1 from walk join e on parent = node where depth < 64) select node, min(depth) as depth from walk group by node""")
def audit_cyclic(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer")
    last = rows.agg(F.concat(F.lit("c"), F.max("c_custkey")).alias("top"))
    edges = rows.select(F.concat(F.lit("c"), "c_custkey").alias("parent"), F.concat(F.lit("c"), F.expr("c_custkey div 2")).alias("child"))
    return audit.descendants(edges.unionByName(last.select(F.lit("c0").alias("parent"), F.col("top").alias("child"))), last.first().top)


@query("""select 'state.' || p_brand || '.' || k as path, count(*) as n, sum(v)::bigint as total from (select p_brand, unnest(['data.q', 'data.n', 'absmax']) as k, unnest([p_size, case when p_partkey % 2 = 0 then 1 end, 1]) as v from part) where v is not null group by 1""")
def audit_flattened(spark: SparkSession, d: str) -> DataFrame:
    inner = F.struct(F.struct(F.col("p_size").alias("q"), F.when(F.col("p_partkey") % 2 == 0, 1).alias("n")).alias("data"), F.lit(1).alias("absmax"))
    leaves = audit.flattened(table(spark, d, "part").select(F.create_map(F.col("p_brand"), inner).alias("state")), "state", "state")
    return leaves.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))
