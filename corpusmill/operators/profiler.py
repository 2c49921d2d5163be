"""Profiler exports: kernel tables, memory operations, per-kernel details and traces.

Lines are rows (run, line_no, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.scalars import DECIMAL_MB, NUMBER, duration_ms, number, percent, to_ms, used_percent, whole
from corpusmill.operators.scans import last_value
from corpusmill.sources.json_elements import json_elements
from corpusmill.sources.logs import columns, section, settled

# Parts of names that mark matrix kernels, and their kinds in the order of the tests.
GEMM_MARKERS = ("gemm", "nvjet", "block_scaled", "tensorop_bf16", "tensorop_s1688", "ue8m0xe4m3", "volta_sgemm", "ampere_sgemm")
KERNEL_KINDS = (
    ("flashinfer_mxfp8_cutlass", "devicegemmmxfp8gemmsm120|mxfp8"), ("te_blockscaled_mxfp8", "block_scaled|ue8m0xe4m3"), ("cutlass_bf16_tc", "tensorop_bf16"),
    ("nvjet_sm121_tc", "nvjet_sm121"), ("cutlass_tc", "tensorop_s1688gemm"), ("cublas_gemm", "cublas"), ("cutlass_gemm", "cutlass"),
)
OTHER_KERNEL = "gemm_kernel"
MEMOPS_MARKER = "CUDA GPU MemOps Summary (by Size)"


def is_gemm(name: Column) -> Column:
    return F.lower(name).rlike("|".join(GEMM_MARKERS))


def kernel_kind(name: Column) -> Column:
    out = F.lit(OTHER_KERNEL)
    for kind, pattern in reversed(KERNEL_KINDS):
        out = F.when(F.lower(name).rlike(pattern), kind).otherwise(out)
    return out


def kernel_csv(rows: DataFrame) -> DataFrame:
    """Typed rows of a kernel CSV read as strings by its header; cells that are no number are null."""
    return rows.select(
        F.col("Name").alias("name"), percent(F.col("`Time (%)`")).alias("time_pct"), (whole(F.col("`Total Time (ns)`")) / 1e6).alias("total_ms"),
        whole(F.col("Instances")).alias("instances"), (number(F.col("`Avg (ns)`")) / 1e6).alias("avg_ms"),
    )


def read_kernel_csv(spark: SparkSession, path: str) -> DataFrame:
    """``kernel_csv`` of CSV files with a header; names may be quoted and hold commas."""
    return kernel_csv(spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path))


#: What an event of a trace file holds, as far as it is read; ids are numbers or text.
EVENT = "cat string, name string, dur double, args struct<`External id`:string,`Input type`:array<string>,`Input Dims`:array<array<string>>>"


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """Events for ``trace_groups`` of trace files, one JSON object each: every event a row, with its place (byte) in its file.

    Files are read by byte ranges, so one large trace is spread over tasks.
    """
    rows = json_elements(spark, path, "traceEvents").select(F.element_at(F.split("file", "/"), -1).alias("file"), F.col("at").alias("ord"), F.from_json("value", EVENT).alias("e"))
    dims = F.transform("e.args.`Input Dims`", lambda d: F.array_join(d, "x"))
    return rows.select(
        "file", "ord", "e.cat", "e.name", "e.dur", F.col("e.args.`External id`").alias("ext_id"),
        F.coalesce(F.col("e.args.`Input type`"), F.array().cast("array<string>")).alias("input_types"), F.coalesce(dims, F.array().cast("array<string>")).alias("input_dims"),
    )


def device_rows(lines: DataFrame) -> DataFrame:
    """Typed rows of device lines (run, value) of seven comma columns: index, name, used and total MiB, load and temperature, power;
    shorter lines go, figures that are no number are null."""
    c = F.transform(F.split("value", ","), lambda x: F.trim(x))
    at = lambda i, kind: F.get("c", F.lit(i)).try_cast(kind)
    rows = lines.withColumn("c", c).filter(F.size("c") >= 7).select(
        "run", at(0, "int").alias("index"), F.get("c", F.lit(1)).alias("name"), at(2, "long").alias("used_mib"), at(3, "long").alias("total_mib"), at(4, "int").alias("load_pct"),
        at(5, "int").alias("temp_c"), at(6, "double").alias("power_w"),
    )
    return rows.withColumn("mem_pct", used_percent(F.col("used_mib"), F.col("total_mib")))


def disk_rows(mounts: DataFrame) -> DataFrame:
    """label, total_gb, used_gb, free_gb, pct of mounts (label, total, used, free in bytes); mounts that are not there (null) go."""
    gb = lambda c: F.round(F.col(c) / 1e9, 1).alias(f"{c}_gb")
    there = mounts.filter("total is not null and used is not null and free is not null")
    return there.select("run", "label", gb("total"), gb("used"), gb("free"), used_percent(F.col("used"), F.col("total")).alias("pct"))


def _cut(lines: DataFrame, most: int) -> DataFrame:
    """``lines`` with ``c``, their columns."""
    return settled(lines.withColumn("c", columns(F.col("value"), most)))


def torch_table(lines: DataFrame) -> DataFrame:
    """name, cuda_total_ms, self_cuda_ms, self_cuda_pct, calls of an operator table with 14 columns or more."""
    at = lambda i: F.get("c", F.lit(i))
    rows = _cut(lines, -1).filter(~F.trim("value").startswith("-") & ~F.trim("value").startswith("Name") & (F.size("c") >= 14)).select(
        at(0).alias("name"), duration_ms(at(8)).alias("cuda_total_ms"), duration_ms(at(6)).alias("self_cuda_ms"), percent(at(7)).alias("self_cuda_pct"),
        whole(F.element_at("c", -1)).alias("calls"),
    )
    return settled(rows).dropna().filter("cuda_total_ms > 0 or self_cuda_ms > 0")


def kernel_table(lines: DataFrame) -> DataFrame:
    """name, time_pct, total_s, instances, avg_ms of lines with nine columns whose figures are numbers."""
    c = F.col("c")
    rows = _cut(lines, 9).filter(F.size(c) == 9).select(
        c[8].alias("name"), number(c[0]).alias("time_pct"), (whole(c[1]) / 1e9).alias("total_s"), whole(c[2]).alias("instances"), (number(c[3]) / 1e6).alias("avg_ms")
    )
    return settled(rows).dropna()


def memory_operations(lines: DataFrame) -> DataFrame:
    """operation, total_bytes, count of the lines after the section's marker."""
    inside, c = section(lines, F.contains(F.col("value"), F.lit(MEMOPS_MARKER))), F.col("c")
    rows = _cut(inside, 8).filter(F.size(c) == 8).select("run", c[7].alias("operation"), F.bround(number(c[0]) * DECIMAL_MB).cast("long").alias("total_bytes"), whole(c[1]).alias("n"))
    return settled(rows).dropna()


def header_name(value: Column) -> Column:
    """The kernel's name on a header line, null on others."""
    text = F.trim(value)
    is_header = F.contains(text, F.lit(", Context ")) & F.contains(text, F.lit(", Stream ")) & F.contains(text, F.lit(", Device "))
    launch = F.substring_index(text, ", Context ", 1)
    return F.when(is_header, F.coalesce(F.nullif(F.regexp_extract(launch, r"^(.+)\s+\([^()]*\)x\([^()]*\)$", 1), F.lit("")), launch))


def kernel_details(lines: DataFrame) -> DataFrame:
    """Per run and kernel: samples, mean and greatest duration, mean compute and memory throughput."""
    duration, share = rf"^Duration\s+(ns|us|ms|s)\s+({NUMBER})$", rf"^(Memory Throughput|Compute \(SM\) Throughput)\s+%\s+({NUMBER})$"
    text = F.trim("value")
    rows = last_value(lines.select("run", "line_no", "value"), ["run"], ["line_no"], header_name(F.col("value")), "name").filter("name is not null")
    took = F.when(text.rlike(duration), to_ms(F.regexp_extract(text, duration, 2).try_cast("double"), F.regexp_extract(text, duration, 1)))
    part = F.when(text.rlike(share), F.regexp_extract(text, share, 2).try_cast("double"))
    memory = F.regexp_extract(text, share, 1) == "Memory Throughput"
    rows = rows.select("run", "name", took.alias("ms"), F.when(memory, part).alias("memory"), F.when(~memory, part).alias("compute"))
    return rows.groupBy("run", "name").agg(
        F.greatest(F.count("ms"), F.count("memory"), F.count("compute")).alias("n"), F.round(F.avg("ms"), 6).alias("avg_ms"), F.round(F.max("ms"), 6).alias("max_ms"),
        F.round(F.avg("compute"), 6).alias("compute_pct"), F.round(F.avg("memory"), 6).alias("memory_pct"),
    )


def heaviest_details(details: DataFrame, n: int) -> DataFrame:
    """The n kernels of each run with the most time, by count on ties."""
    order = [F.desc(F.coalesce("avg_ms", F.lit(0.0)) * F.col("n")), F.desc("n"), F.col("name")]
    return details.withColumn("_rank", F.row_number().over(Window.partitionBy("run").orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def top(rows: DataFrame, by: str, n: int, tie: str = "name") -> DataFrame:
    return rows.orderBy(F.desc(by), tie).limit(n)


def trace_groups(events: DataFrame) -> DataFrame:
    """Matrix kernels grouped by kind and by the operator that launched them.

    Events: ord, cat, name, dur, ext_id (text), input_types, input_dims (arrays).  Of several operators with a kernel's id
    the one with inputs, then with the longest duration, then the first counts.
    """
    has = (F.size("input_types") > 0) | (F.size("input_dims") > 0)
    order = [F.desc(F.coalesce(has, F.lit(False))), F.desc(F.coalesce("dur", F.lit(0.0))), F.col("ord")]
    ops = events.filter("cat = 'cpu_op' and ext_id is not null").withColumn("_rank", F.row_number().over(Window.partitionBy("ext_id").orderBy(*order)))
    ops = ops.filter("_rank = 1").select(F.col("ext_id").alias("_id"), F.col("name").alias("cpu_op"), F.col("input_types").alias("types"), F.col("input_dims").alias("dims"))
    kernels = events.filter(F.col("cat").eqNullSafe("kernel") & is_gemm(F.coalesce("name", F.lit("")))).select("ord", "name", "dur", "ext_id")
    both = kernels.join(ops, F.col("ext_id") == F.col("_id"), "left")
    empty = F.array().cast("array<string>")
    keys = [kernel_kind(F.col("name")).alias("kind"), F.coalesce("cpu_op", F.lit("<unlinked>")).alias("cpu_op"), F.coalesce("types", empty).alias("types"), F.coalesce("dims", empty).alias("dims")]
    return both.groupBy(*keys).agg(F.count("*").alias("calls"), F.round(F.sum("dur"), 6).alias("total_us"), F.min_by("name", "ord").alias("sample"))


def latest_file(files: DataFrame, pattern: str) -> DataFrame:
    """run and the file with the greatest step in its name; a name without a step counts as -1."""
    step = F.coalesce(F.nullif(F.regexp_extract("file", pattern, 1), F.lit("")).try_cast("int"), F.lit(-1))
    return files.groupBy("run").agg(F.max_by("file", F.struct(step, "file")).alias("file"))
