"""Profiler tables over ``lineitem``, ``part`` and ``orders``: lines are rendered from the rows and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.scalars import duration_ms
from corpusmill.operators import profiler
from corpusmill.plans.registry import query
from corpusmill.sources import sinks
from corpusmill.sources.tables import scratch_path, table


def _parts(spark: SparkSession, d: str) -> DataFrame:
    """run, line_no, p: one row per part, 20 runs; dealt out, for the parts are a small file that few tasks would read."""
    parts = table(spark, d, "part").select("p_partkey", "p_type", "p_size", "p_retailprice").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return parts.select(F.concat(F.lit("run"), F.col("p_partkey") % 20).alias("run"), F.col("p_partkey").alias("line_no"), "p_partkey", "p_type", "p_size", F.floor("p_retailprice").alias("price"))


def _lines(spark: SparkSession, d: str, text) -> DataFrame:
    return _parts(spark, d).select("run", "line_no", text.alias("value"))


@query("""select 'k,' || p_type || p_partkey % 11 as name, (p_partkey % 100 + 0.5)::double as time_pct, (floor(p_retailprice)::bigint * 1000) / 1e6 as total_ms, p_size::bigint as instances from part where p_size % 7 <> 0
union all select 'k,' || p_type || p_partkey % 11, (p_partkey % 100 + 0.5)::double, (floor(p_retailprice)::bigint * 1000) / 1e6, null from part where p_size % 7 = 0""")
def profiler_kernel_csv(spark: SparkSession, d: str) -> DataFrame:
    rows = _parts(spark, d).select(
        F.format_string("%d.5%%", F.col("p_partkey") % 100).alias("Time (%)"), F.format_string("%,d", F.col("price") * 1000).alias("Total Time (ns)"),
        F.expr("if(p_size % 7 = 0, 'n/a', cast(p_size as string))").alias("Instances"), F.lit("12.5").alias("Avg (ns)"),
        F.concat(F.lit("k,"), "p_type", F.col("p_partkey") % 11).alias("Name"),
    )
    path = scratch_path(spark, "kernel-csv")
    sinks.append_csv(rows, path)
    return profiler.read_kernel_csv(spark, path).drop("avg_ms")


@query("""select p_type || p_partkey as name, (floor(p_retailprice)::bigint * 1000000) / 1e9 as total_s from part where p_size % 5 <> 0 order by 2 desc, 1 limit 25""")
def profiler_kernel_table(spark: SparkSession, d: str) -> DataFrame:
    text = F.format_string("  %d.0   %,d  %s   1,000.5   9   9   9   9   %s", F.col("p_partkey") % 100, F.col("price") * 1000000, F.expr("if(p_size % 5 = 0, '?', cast(p_size as string))"), F.concat("p_type", "p_partkey"))
    return profiler.top(profiler.kernel_table(_lines(spark, d, text)), "total_s", 25).select("name", "total_s")


@query("""select 'aten::op' || p_partkey as name, (floor(p_retailprice)::bigint * 1000.0)::double as cuda_total_ms, (p_size / 1000.0)::double as self_cuda_ms, (p_partkey % 90 + 0.25)::double as self_cuda_pct, p_size::bigint as calls from part where p_partkey % 9 <> 0""")
def profiler_torch_table(spark: SparkSession, d: str) -> DataFrame:
    cell = F.expr("if(p_partkey % 9 = 0, '--', concat(cast(price as string), 's'))")
    text = F.format_string("   aten::op%d   1%%  1us  1%%  2us  1us  %dus  %d.25%%  %s  1us  0b  0b  0b  0b  %d", "p_partkey", "p_size", F.col("p_partkey") % 90, cell, "p_size")
    return profiler.torch_table(_lines(spark, d, text))


@query("""select 'run' || p_partkey % 20 as run, 'op' || p_partkey % 6 as operation, sum(p_size * 1000000 + 500000)::bigint as total_bytes, sum(p_partkey % 50)::bigint as n from part
where p_partkey > 40 and p_partkey % 9 <> 0 group by 1, 2""")
def profiler_memory_operations(spark: SparkSession, d: str) -> DataFrame:
    row = F.format_string("%d.5   %d  1  1  1  1  1  op%d", "p_size", F.col("p_partkey") % 50, F.col("p_partkey") % 6)
    # Each run has a row before its marker line, and noise after it.
    text = F.when(F.col("p_partkey").between(21, 40), f"** {profiler.MEMOPS_MARKER}:").when(F.col("p_partkey") % 9 != 0, row).otherwise("  noise")
    rows = profiler.memory_operations(_lines(spark, d, text))
    return rows.groupBy("run", "operation").agg(F.sum("total_bytes").alias("total_bytes"), F.sum("n").alias("n"))


DETAILS = """p as (select 'run' || p_partkey % 20 as run, p_partkey as line_no, p_size, case when p_partkey // 20 % 4 = 0 then 'kern' || p_size % 3 end as head, p_partkey // 20 % 4 as what from part),
c as (select *, last_value(head ignore nulls) over (partition by run order by line_no) as name from p),
k as (select run, name, greatest(count(case when what = 1 then 1 end), count(case when what = 2 then 1 end), count(case when what = 3 then 1 end)) as n,
  round(avg(case when what = 1 then p_size / 1000.0::double end), 6) as avg_ms, round(max(case when what = 1 then p_size / 1000.0::double end), 6) as max_ms,
  round(avg(case when what = 2 then (p_size % 60 + 0.5)::double end), 6) as compute_pct, round(avg(case when what = 3 then (p_size % 70 + 0.5)::double end), 6) as memory_pct from c where name is not null group by 1, 2)"""


def _details(spark: SparkSession, d: str) -> DataFrame:
    text = F.expr("""case p_partkey div 20 % 4 when 0 then concat('  kern', p_size % 3, ' (1, 1, 1)x(128, 1, 1), Context 1, Stream 7, Device 0, CC 9.0') when 1 then concat('    Duration     us    ', p_size)
      when 2 then concat('  Compute (SM) Throughput  %  ', p_size % 60, '.5') else concat('  Memory Throughput  %  ', p_size % 70, '.5') end""")
    return profiler.kernel_details(_lines(spark, d, text))


@query(f"with {DETAILS} select * from k")
def profiler_kernel_details(spark: SparkSession, d: str) -> DataFrame:
    return _details(spark, d)


@query(f"with {DETAILS} select run, name, n from (select *, row_number() over (partition by run order by coalesce(avg_ms, 0) * n desc, n desc, name) as r from k) where r <= 2")
def profiler_heaviest_details(spark: SparkSession, d: str) -> DataFrame:
    return profiler.heaviest_details(_details(spark, d), 2).select("run", "name", "n")


KERNELS = "('sm90_gemm_x', 'nvjet_sm121_y', 'MXFP8_block_scaled', 'cutlass_tensorop_bf16_s16816gemm', 'block_scaled_z', 'elementwise', 'cublasLt_sgemm', 'cutlass_gemm_a')"
NAMES = "array" + KERNELS
KIND = """case when lower(name) like '%mxfp8%' then 'flashinfer_mxfp8_cutlass' when lower(name) like '%block_scaled%' or lower(name) like '%ue8m0xe4m3%' then 'te_blockscaled_mxfp8'
  when lower(name) like '%tensorop_bf16%' then 'cutlass_bf16_tc' when lower(name) like '%nvjet_sm121%' then 'nvjet_sm121_tc' when lower(name) like '%tensorop_s1688gemm%' then 'cutlass_tc'
  when lower(name) like '%cublas%' then 'cublas_gemm' when lower(name) like '%cutlass%' then 'cutlass_gemm' else 'gemm_kernel' end"""
LIST = KERNELS.replace("(", "[").replace(")", "]")


@query(f"""with k as (select {LIST}[(l_partkey % 8 + 1)::int] as name from lineitem) select {KIND} as kind, count(*) as n from k where not name like 'element%' group by 1""")
def profiler_kernel_kinds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.expr(f"{NAMES}[l_partkey % 8]").alias("name"))
    return rows.filter(profiler.is_gemm(F.col("name"))).groupBy(profiler.kernel_kind(F.col("name")).alias("kind")).agg(F.count("*").alias("n"))


@query(f"""with op as (select o_orderkey // 2 as id, o_orderkey as ord, o_orderpriority as cpu_op, o_totalprice as dur, case when o_orderkey % 3 = 0 then [o_orderstatus] else [] end as types from orders),
best as (select * from (select *, row_number() over (partition by id order by len(types) > 0 desc, dur desc, ord) as r from op) where r = 1),
k as (select l_orderkey * 10 + l_linenumber as ord, {LIST}[(l_partkey % 8 + 1)::int] as name, l_quantity as dur, l_orderkey as id from lineitem)
select {KIND} as kind, coalesce(cpu_op, '<unlinked>') as cpu_op, coalesce(array_to_string(types, ','), '') as types, count(*) as calls, round(sum(k.dur), 6) as total_us from k left join best using (id)
where not name like 'element%' group by 1, 2, 3""")
def profiler_trace_groups(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    ops = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ord"), F.lit("cpu_op").alias("cat"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("dur"),
        F.expr("cast(o_orderkey div 2 as string)").alias("ext_id"), F.when(F.col("o_orderkey") % 3 == 0, F.array("o_orderstatus")).otherwise(none).alias("input_types"), none.alias("input_dims"),
    )
    kernels = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.lit("kernel").alias("cat"), F.expr(f"{NAMES}[l_partkey % 8]").alias("name"), F.col("l_quantity").alias("dur"),
        F.col("l_orderkey").cast("string").alias("ext_id"), none.alias("input_types"), none.alias("input_dims"),
    )
    return profiler.trace_groups(ops.unionByName(kernels)).select("kind", "cpu_op", F.array_join("types", ",").alias("types"), "calls", "total_us")


@query("""select 'run' || p_partkey % 20 as run, 'train_step_' || max(p_size) || '_cuda_table.txt' as file from part group by 1""")
def profiler_latest_file(spark: SparkSession, d: str) -> DataFrame:
    files = _parts(spark, d).select("run", F.explode(F.array(F.concat(F.lit("train_step_"), "p_size", F.lit("_cuda_table.txt")), F.lit("notes.txt"))).alias("file"))
    return profiler.latest_file(files, r"train_step_(\d+)_cuda_table")


@query("""select p_partkey, case p_partkey % 5 when 0 then p_size / 1e6 when 1 then p_size / 1000.0::double when 2 then p_size::double when 3 then p_size * 1000.0::double end as ms from part""")
def profiler_durations(spark: SparkSession, d: str) -> DataFrame:
    unit = F.expr("array('ns', ' us', 'ms', ' s', 'min')[p_partkey % 5]")
    return table(spark, d, "part").select("p_partkey", duration_ms(F.concat(F.col("p_size").cast("string"), unit)).alias("ms"))


#: Orders for which a trace file of each priority is written.
TRACE_ORDERS = 500_000


@query(f"""with op as (select o_orderkey as id, o_orderpriority as cpu_op, o_totalprice as dur from orders), k as (select l_orderkey as id, {LIST}[(l_partkey % 8 + 1)::int] as name, l_quantity as dur from lineitem)
select {KIND} as kind, coalesce(cpu_op, '<unlinked>') as cpu_op, case when op.id is not null then 'float' else '' end as types, case when op.id is not null then '4x8' else '' end as dims, count(*) as calls, round(sum(k.dur), 6) as total_us from k left join op using (id) where not name like 'element%' group by all""")
def profiler_trace_file(spark: SparkSession, d: str) -> DataFrame:
    # Trace files of each order priority, as many as a file's number of orders asks for: operators, and the kernels of their orders.
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    n_files = orders.count() // TRACE_ORDERS + 1
    file = lambda key: [F.coalesce("o_orderpriority", F.lit("none")).alias("priority"), F.pmod(F.hash(key), F.lit(n_files)).alias("part")]
    op = F.struct(
        F.lit("cpu_op").alias("cat"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("dur"),
        F.struct(F.col("o_orderkey").alias("External id"), F.array(F.lit("float")).alias("Input type"), F.array(F.array(F.lit(4), F.lit(8))).alias("Input Dims")).alias("args"),
    )
    kernel = F.struct(F.lit("kernel").alias("cat"), F.expr(f"{NAMES}[l_partkey % 8]").alias("name"), F.col("l_quantity").alias("dur"), F.struct(F.col("l_orderkey").cast("string").alias("External id")).alias("args"))
    kernels = table(spark, d, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey", "left")
    events = orders.select(*file("o_orderkey"), F.to_json(op).alias("e")).unionByName(kernels.select(*file("l_orderkey"), F.to_json(kernel).alias("e")))
    # A file's lines: the head with an event of its own kind, the events, the end; the sort may spill, no file is held whole.
    lines = events.select("priority", "part", F.lit(1).alias("place"), F.concat(F.lit(","), "e").alias("value"))
    frame = F.expr("""inline(array(struct(0 as place, '{"traceEvents": [{"ph":"M","name":"process_name"}' as value), struct(2 as place, ']}' as value)))""")
    priorities = orders.select(F.explode(F.array(F.coalesce("o_orderpriority", F.lit("none")), F.lit("none"))).alias("priority")).distinct()
    files = priorities.select("priority", F.explode(F.sequence(F.lit(0), F.lit(n_files - 1))).alias("part"))
    lines = lines.unionByName(files.select("priority", "part", frame))
    path = scratch_path(spark, "traces")
    keys = ["priority", "part"]
    lines.repartition(*keys).sortWithinPartitions(*keys, "place").select(*keys, "value").write.partitionBy(*keys).text(path)
    groups = profiler.trace_groups(profiler.read_trace(spark, path))
    return groups.select("kind", "cpu_op", F.array_join("types", ",").alias("types"), F.array_join("dims", ",").alias("dims"), "calls", "total_us")


@query("""select 'gpu' || p_partkey % 8 as run, (p_partkey % 8)::int as idx, 'H' || p_size as name, (p_size * 1000)::bigint as used_mib, case when p_partkey % 5 <> 0 then p_partkey % 90 * 1000 end::bigint as total_mib,
  round(p_size * 1000.0::double / greatest(case when p_partkey % 5 <> 0 then p_partkey % 90 * 1000 end, 1) * 100, 1) as mem_pct, (p_size + 0.25)::double as power_w from part where p_partkey % 7 <> 0""")
def profiler_device_rows(spark: SparkSession, d: str) -> DataFrame:
    line = F.expr("concat_ws(', ', cast(p_partkey % 8 as string), concat('H', p_size), cast(p_size * 1000 as string), if(p_partkey % 5 = 0, '[N/A]', cast(p_partkey % 90 * 1000 as string)), '97', '61', concat(p_size, '.25'))")
    lines = table(spark, d, "part").select(F.concat(F.lit("gpu"), F.col("p_partkey") % 8).alias("run"), F.when(F.col("p_partkey") % 7 == 0, "0, short").otherwise(line).alias("value"))
    return profiler.device_rows(lines).select("run", F.col("index").alias("idx"), "name", "used_mib", "total_mib", "mem_pct", "power_w")


@query("""select 's' || s_suppkey as run, label, round(total / 1e9, 1) as total_gb, round(used / 1e9, 1) as used_gb, round((total - used) / 1e9, 1) as free_gb, round(used / greatest(total, 1) * 100, 1) as pct
from (select s_suppkey, unnest(['root', 'data', 'home']) as label, unnest([s_suppkey * 1000000000.0, case when s_suppkey % 3 <> 0 then s_suppkey * 3000000000.0 end, 5e11])::double as total, s_suppkey * 700000000.0::double as used from supplier) where total is not null""")
def profiler_disk_rows(spark: SparkSession, d: str) -> DataFrame:
    mount = lambda label, total: F.struct(F.lit(label).alias("label"), total.cast("double").alias("total"))
    k = F.col("s_suppkey")
    mounts = F.explode(F.array(mount("root", k * 1e9), mount("data", F.when(k % 3 != 0, k * 3e9)), mount("home", F.lit(5e11))))
    rows = table(spark, d, "supplier").select(F.concat(F.lit("s"), k).alias("run"), mounts.alias("m"), (k * 7e8).cast("double").alias("used"))
    return profiler.disk_rows(rows.select("run", "m.label", "m.total", "used", (F.col("m.total") - F.col("used")).alias("free")))
