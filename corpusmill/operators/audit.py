"""Audits: buckets of parameters, storage and allocations, counters, thresholds, sweep outcomes and error figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

from corpusmill.functions.scalars import GIB, MIB, NUMBER
from corpusmill.operators.scans import handed, last_value, ranged, stored
from corpusmill.operators.selection import order_statistics
from corpusmill.sources.tables import scratch_path

# Parameter leaf names of state-space layers, parts of stack frames that say nothing, and parts of parameter
# names with their groups in the order of the tests.
SCALAR_LEAVES = ("A_log", "dt_bias", "D", "B_bias", "C_bias", "B_norm_weight", "C_norm_weight", "mimo_x", "mimo_z", "mimo_o")
FRAME_NOISE = (
    "memory_snapshot.cpp", "RegisterCUDA_", "RegisterCompositeExplicitAutograd_", "RegisterCompositeImplicitAutograd_", "RegisterBackendSelect.cpp", "VariableType_",
    "python_torch_functions_", "python_variable_methods.cpp", "python_function.cpp", "LinearAlgebra.cpp", "torch/nn/modules/module.py", "torch/_dynamo", "torch/_inductor", "torch/autograd",
)
NAME_GROUPS = (
    ("ngram_hash", ("ngram", "hash")), ("structure", ("structure",)), ("embedding", ("word_embeddings", "embedding")), ("output_layer", ("output_layer",)), ("mtp", ("mtp",)),
    ("moe_shared_experts", ("shared_experts",)), ("moe_experts", (".mlp.experts.", "experts.")), ("moe_router", ("router",)), ("attention", ("self_attention", "cross_attention")),
    ("mamba_mixer", (".mixer.", "mamba")), ("dense_mlp", (".mlp.",)), ("norm", ("norm", "layernorm")),
)
DTYPE_BYTES = {"fp32": 4, "fp16": 2, "bf16": 2, "fp8": 1}
OOM, CRASH = r"OutOfMemoryError|CUDA out of memory", r"SIGABRT|SIGSEGV|RuntimeError|AssertionError"


def parameter_category(name: Column, is_embedding: Column, is_tagged: Column, dims: Column) -> Column:
    leaf = F.substring_index(name, ".", -1)
    return (
        F.when(leaf.isin(*SCALAR_LEAVES), "mamba_scalar_bc").when(is_embedding, "scalar_fallback_embedding_or_output").when(is_tagged, "scalar_fallback_tagged")
        .when(dims != 2, "scalar_fallback_non_2d").otherwise("muon_matrix")
    )


def parameter_group(name: Column) -> Column:
    """The group of a parameter by parts of its name, whatever their case; the first that holds counts."""
    low, out = F.lower(name), F.lit("other")
    for group, parts in reversed(NAME_GROUPS):
        found = F.lit(False)
        for part in parts:
            found |= F.contains(low, F.lit(part))
        out = F.when(found, group).otherwise(out)
    return out


def buckets(rows: DataFrame, sections: dict[str, list[str]], numel: str, nbytes: str) -> DataFrame:
    """section, key (parts joined by |), n, numel, bytes: every section in one pass over the rows."""
    keys = F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.concat_ws("|", *cols).alias("key")) for s, cols in sections.items()]))
    each = rows.select(keys.alias("k"), F.col(numel).alias("numel"), F.col(nbytes).alias("bytes"))
    return each.groupBy("k.section", "k.key").agg(F.count("*").alias("n"), F.sum("numel").alias("numel"), F.sum("bytes").alias("bytes"))


def heaviest_per_section(rows: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("bytes"), "key"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n)


def distinct_storage(rows: DataFrame, keys: list[str], order: str, nbytes: str) -> DataFrame:
    """Adds ``counted``: the bytes on the first row of each storage, 0 on its later aliases; of rows tied in order the smallest is first."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order, nbytes)) == 1
    return rows.withColumn("counted", F.when(first, F.col(nbytes)).otherwise(0))


def size_bucket(n: Column) -> Column:
    return F.when(n > 100 * MIB, ">100MB").when(n > 10 * MIB, ">10MB").when(n > MIB, ">1MB").otherwise("<1MB")


def size_histogram(blocks: DataFrame) -> DataFrame:
    """bucket, n and bytes of the active blocks (state, size)."""
    active = blocks.filter("state = 'active_allocated'")
    return active.groupBy(size_bucket(F.col("size")).alias("bucket")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def useful_frames(frames: Column, most: int = 5) -> Column:
    """The first frames (file names) that say something; the first of all if none does.  Unnamed ones, '' or ??, say nothing."""
    noise = "|".join(p.replace(".", r"\.") for p in FRAME_NOISE)
    good = F.filter(frames, lambda f: F.coalesce((f != "") & (f != "??") & ~f.rlike(noise), F.lit(False)))
    return F.slice(F.when(F.size(good) > 0, good).otherwise(frames), 1, most)


def replay(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    """device, peak, peak_idx, live_end of an allocation trace (device, idx, action, size, addr).

    A free gives back the size of the address's last allocation if that is still live, else its own; live bytes never go
    below 0.  With ``order``, columns that put a device's events in order, these are numbered from 1 and need no ``idx``.  Both
    the last allocation and the live bytes are scans by blocks, so one device, or one address, is spread over all tasks.
    """
    moved = F.col("action").isin("alloc", "free_completed")
    order, numbered = order or ["idx"], bool(order)
    own = events.withColumn("_last", F.when(moved, F.struct("action", "size")))
    own = ranged(own.drop("last"), ["device", "addr"], order)
    found = F.aggregate("_ranges", F.lit(None).cast(own.schema["_last"].dataType), lambda x, r: F.coalesce(r["_t"]["v"], x))
    own = handed(own, ["device", "addr"], [F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_at"))).alias("v")], found)
    earlier = Window.partitionBy("_range", "device", "addr").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = own.withColumn("last", F.coalesce(F.last("_last", ignorenulls=True).over(earlier), "_x"))
    given = F.when((F.col("addr") != 0) & (F.col("last")["action"] == "alloc"), F.col("last")["size"]).otherwise(F.col("size"))
    change = F.when(~moved, 0).when(F.col("action") == "alloc", F.col("size")).otherwise(-given)
    rows = rows.select("device", "action", change.cast("long").alias("change"), *[c for c in order if c not in ("device", "action", "change")])
    # From x bytes on, x + a or what was summed up since the sum was least, if more: the sum so far less its least, or plus x.
    so_far = Window.partitionBy("_range", "device").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged(rows, ["device"], order)
    rows = stored(rows.withColumns({"_n": F.count("*").over(so_far), "_sum": F.sum("change").over(so_far)}).withColumn("_least", F.min("_sum").over(so_far)), "replay-sums")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("live"))
    step = lambda x, r: F.struct((x["n"] + r["_t"]["n"]).alias("n"), (r["_t"]["sum"] + F.greatest(x["live"], -r["_t"]["least"])).alias("live"))
    rows = handed(rows, ["device"], [F.max("_n").alias("n"), F.sum("change").alias("sum"), F.min("_sum").alias("least")], F.aggregate("_ranges", zero, step))
    x = F.coalesce("_x", zero)
    rows = rows.withColumn("at", F.struct((x["n"] + F.col("_n")).alias("n"), (F.col("_sum") + F.greatest(x["live"], -F.col("_least"))).alias("live")))
    rows = rows.filter(moved).select("device", "action", F.col("at.live").alias("live"), (F.col("at.n") if numbered else F.col("idx")).alias("idx"))
    grown = F.when((F.col("action") == "alloc") & (F.col("live") > 0), F.struct(F.col("live").alias("live"), (-F.col("idx")).alias("back")))
    return rows.groupBy("device").agg(F.max(grown).alias("top"), F.max_by("live", "idx").alias("live_end")).select(
        "device", F.coalesce("top.live", F.lit(0)).alias("peak"), F.coalesce(-F.col("top.back"), F.lit(-1)).alias("peak_idx"), "live_end"
    )


def last_counters(lines: DataFrame, marker: str, keys: tuple[str, ...]) -> DataFrame:
    """run, key, value: from literal dicts after the marker, the last line's; ``key = N`` anywhere outranks them."""
    payload = F.when(F.contains(F.col("value"), F.lit(marker)), F.element_at(F.split("value", marker, 2), -1))
    parts = []
    for key in keys:
        literal = F.nullif(F.regexp_extract(payload, rf"['\"]{key}['\"]:\s*(\d+)", 1), F.lit("")).try_cast("long")
        stated = F.element_at(F.regexp_extract_all("value", F.lit(rf"\b{key}\s*=\s*(\d+)\b"), F.lit(1)), -1).try_cast("long")
        parts += [F.struct(F.lit(key).alias("key"), F.lit(p).alias("priority"), v.alias("v")) for p, v in ((0, literal), (1, F.when(F.col("value").rlike(rf"\b{key}\s*=\s*\d+\b"), stated)))]
    found = lines.select("run", "line_no", F.explode(F.array(*parts)).alias("k")).filter("k.v is not null")
    return found.groupBy("run", "k.key").agg(F.max_by("k.v", F.struct("k.priority", "line_no")).alias("value"))


def max_bytes(values: DataFrame) -> DataFrame:
    """run, max_bytes of figures in GiB, MB or bytes (columns value, unit)."""
    scaled = F.when(F.col("unit") == "GiB", F.bround(F.col("value") * GIB)).when(F.col("unit") == "MB", F.bround(F.col("value") * MIB)).otherwise(F.col("value"))
    return values.groupBy("run").agg(F.max(scaled.cast("long")).alias("max_bytes"))


def inferred_experts(declared: DataFrame, groups: DataFrame) -> DataFrame:
    """run, n_sizes, used: the one observed group size, else the declared number."""
    seen = groups.filter("size > 0").groupBy("run").agg(F.countDistinct("size").alias("n_sizes"), F.min("size").alias("size"))
    rows = declared.join(seen, "run", "full_outer")
    return rows.select("run", F.coalesce("n_sizes", F.lit(0)).alias("n_sizes"), F.when(F.col("n_sizes") == 1, F.col("size")).otherwise(F.col("declared")).alias("used"))


def residual(total: Column, *parts: Column) -> Column:
    """What the parts leave of the total, at least 0."""
    return F.greatest(total - sum(parts[1:], parts[0]), F.lit(0))


def threshold_errors(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """run, metric, problem: metrics (run, metric, value) against limits (metric, op, bound); a missing value is a problem."""
    every = limits.agg(F.collect_list(F.struct("metric", "op", "bound")).alias("limits"))  # one row
    runs = metrics.select("run").distinct().crossJoin(F.broadcast(every)).select("run", F.explode("limits").alias("l")).select("run", "l.*")
    wanted = runs.join(metrics, ["run", "metric"], "left")
    fits = F.when(F.col("op") == ">=", F.col("value") >= F.col("bound")).otherwise(F.col("value") <= F.col("bound"))
    problem = F.when(F.col("value").isNull(), "missing").when(~fits, F.concat(F.lit("not "), "op", F.lit(" bound")))
    return wanted.select("run", "metric", problem.alias("problem")).filter("problem is not null")


def counter_errors(counters: DataFrame, must_be_zero: tuple[str, ...], any_above_zero: tuple[str, ...]) -> DataFrame:
    """run, problem of counter maps (run, counters): a missing key differs from 0."""
    at = lambda k: F.try_element_at("counters", F.lit(k))
    zero = [c for k in must_be_zero for c in (F.when(at(k).isNull(), f"{k} missing"), F.when(at(k) != 0, f"{k} not zero"))]
    worked = F.exists(F.array(*map(at, any_above_zero)), lambda v: F.coalesce(v, F.lit(0)) > 0)
    above = F.when(~worked, "no work counted")
    return counters.select("run", F.explode(F.array_compact(F.array(*zero, above))).alias("problem"))


def readiness(facts: DataFrame, needed: list[str]) -> DataFrame:
    """run, ready, missing: which of the needed columns are null."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in needed]))
    return facts.select("run", (F.size(missing) == 0).alias("ready"), F.array_join(missing, ",").alias("missing"))


def bench_stats(samples: DataFrame) -> DataFrame:
    """name, n, mean, p50 (the sample at n div 2), p99 (at int(0.99 n)), median, and the population deviation of (name, ms).

    A null or NaN is no sample.  No name's samples meet in one task, however many they are.  The order in which sums are added shows
    in their last bits, so means and deviations are rounded to nine digits first: a half is then a half.
    """
    known = samples.filter("ms is not null and not isnan(ms)")
    sums = known.groupBy("name").agg(F.round(F.round(F.avg("ms"), 9), 6).alias("mean"), F.round(F.round(F.stddev_pop("ms"), 9), 6).alias("stdev"))
    ranks = {"p50": "n div 2 + 1", "p99": "floor(n * 0.99) + 1", "_low": "(n + 1) div 2", "_high": "n div 2 + 1"}
    places = order_statistics(known, ["name"], "ms", ranks).withColumnRenamed("name", "_name")
    both = sums.join(places, F.col("name").eqNullSafe(F.col("_name")))
    return both.select("name", "n", "mean", "p50", "p99", F.round((F.col("_low") + F.col("_high")) / 2, 6).alias("median"), "stdev")


def lower_median(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, lower_median: the value at (n + 1) div 2, of the two in the middle the lower."""
    return order_statistics(rows, [key], value, {"lower_median": "(n + 1) div 2"}).select(key, "lower_median")


def gradient_verdict(lines: DataFrame) -> DataFrame:
    """run, finite, nan, total of step lines with throughput, and a verdict."""
    steps = lines.filter(F.col("value").rlike("iteration.*throughput"))
    nan = F.contains(F.col("value"), F.lit("grad norm: nan"))
    rows = lines.select("run").distinct().join(steps.groupBy("run").agg(F.count_if(~nan).alias("finite"), F.count_if(nan).alias("nan"), F.count("*").alias("total")), "run", "left").fillna(0)
    verdict = F.when((F.col("nan") == 0) & (F.col("total") > 0), "good").when(F.col("nan") > 0, "bad").otherwise("unknown")
    return rows.withColumn("verdict", verdict)


def sweep_status(configs: DataFrame, lines: DataFrame, seq_length: int = 4096, first: int = 30, last: int = 50) -> DataFrame:
    """config, iter_ms, tok_sec, peak_gb, loss, status of configs (config, gbs) and their log lines.

    The first that holds counts: no log, out of memory (with the first peak named), crash, no times in the window, else OK
    (with the greatest peak).
    """
    value, it = F.col("value"), F.regexp_extract("value", r"iteration\s+(\d+)/", 1).try_cast("int")
    peak = F.nullif(F.regexp_extract(value, r"peak_alloc_gib=([0-9.]+)", 1), F.lit("")).try_cast("double")
    ms = F.when(it.between(first, last), F.nullif(F.regexp_extract(value, r"elapsed time per iteration \(ms\): ([0-9.]+)", 1), F.lit("")).try_cast("double"))
    loss = F.when((it == last) & value.rlike("lm loss:"), F.regexp_extract(value, rf"lm loss:\s*({NUMBER})", 1).try_cast("double"))
    facts = lines.select("run", "line_no", value.rlike(OOM).alias("oom"), value.rlike(CRASH).alias("crash"), peak.alias("peak"), ms.alias("ms"), loss.alias("loss")).groupBy("run").agg(
        F.bool_or("oom").alias("oom"), F.bool_or("crash").alias("crash"), F.min_by("peak", F.when(F.col("peak").isNotNull(), F.col("line_no"))).alias("first_peak"), F.max("peak").alias("max_peak"),
        F.round(F.avg("ms"), 1).alias("ms"), F.max_by("loss", F.when(F.col("loss").isNotNull(), F.col("line_no"))).alias("loss"),
    )
    rows = configs.join(facts, F.col("config") == F.col("run"), "left")
    status = F.when(F.col("run").isNull(), "NO_LOG").when(F.col("oom"), "OOM").when(F.col("crash"), "CRASH").when(F.col("ms").isNull(), "NO_ITER_DATA").otherwise("OK")
    good = status == "OK"
    return rows.select(
        "config", F.when(good, F.col("ms")).alias("iter_ms"), F.when(good, F.round(F.col("gbs") * seq_length * 1000 / F.col("ms"))).alias("tok_sec"),
        F.when(good, F.col("max_peak")).when(status == "OOM", F.col("first_peak")).alias("peak_gb"), F.when(good, F.col("loss")).alias("loss"), status.alias("status"),
    )


def last_n_mean(rows: DataFrame, n: int) -> DataFrame:
    """run, n, mean_ms of each run's last n rows (run, it, ms)."""
    rank = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("it")))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).groupBy("run").agg(F.count("*").alias("n"), F.round(F.avg("ms"), 6).alias("mean_ms"))


def nan_sweep(lines: DataFrame, exits: DataFrame) -> DataFrame:
    """run, nan_iter, last_grad, status: the iteration current at the last nan or inf norm, and the status by exit code."""
    it = F.nullif(F.regexp_extract("value", r"iteration\s+(\d+)/", 1), F.lit("")).try_cast("int")
    grad = F.nullif(F.regexp_extract("value", r"(?i)grad norm:\s*(nan|inf|[\d.eE+-]+)", 1), F.lit(""))
    rows = last_value(lines.select("run", "line_no", it.alias("own"), grad.alias("grad")), ["run"], ["line_no"], F.col("own"), "it")
    bad = F.lower("grad").isin("nan", "inf")
    facts = rows.groupBy("run").agg(F.max_by("it", F.when(bad, F.col("line_no"))).alias("nan_iter"), F.max_by("grad", F.when(F.col("grad").isNotNull(), F.col("line_no"))).alias("last_grad"))
    status = F.when(F.col("exit_code") == 124, "timeout").when(F.col("nan_iter").isNotNull(), "nan").when(F.col("exit_code") == 0, "finite").otherwise("crash")
    return exits.join(facts, "run", "left").select("run", "nan_iter", "last_grad", status.alias("status"))


def status_counts(rows: DataFrame, known: tuple[str, ...], other: str = "crash") -> DataFrame:
    """status, n; a status that is not known counts as ``other``."""
    status = F.when(F.col("status").isin(*known), F.col("status")).otherwise(other)
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def dtype_audit(rows: DataFrame, allowed: str) -> DataFrame:
    """prefix, dtype, tensors, elems, and whether the prefix holds any other dtype than the allowed."""
    each = rows.groupBy("prefix", "dtype").agg(F.count("*").alias("tensors"), F.sum("elems").alias("elems"))
    return each.withColumn("prefix_mixed", F.bool_or(F.col("dtype") != allowed).over(Window.partitionBy("prefix")))


def errors(pairs: DataFrame, eps: float = 1e-8, limit: float = 0.01) -> DataFrame:
    """Error figures of aligned values (grp, actual, expected); a value that is not finite makes the maxima infinite."""
    infinite = lambda c: F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    a, e = F.col("actual"), F.col("expected")
    diff = F.when(infinite(a) | infinite(e), F.lit(float("inf"))).otherwise(F.abs(a - e))
    rows = pairs.select("grp", diff.alias("d"), (diff / (F.abs(e) + eps)).alias("r"), e.alias("e"))
    return rows.groupBy("grp").agg(
        F.round(F.max("d"), 6).alias("max_abs"), F.round(F.avg("d"), 6).alias("mean_abs"), F.round(F.max("r"), 6).alias("max_rel"), F.round(F.avg("r"), 6).alias("mean_rel"),
        F.count_if(F.col("r") > limit).alias("n_above"), F.round(100 * F.count_if(F.col("r") > limit) / F.count("*"), 4).alias("pct_above"),
        F.round(F.sqrt(F.sum(F.col("d") * F.col("d")) / F.sum(F.col("e") * F.col("e"))), 6).alias("rel_l2"),
    )


def position_histogram(rows: DataFrame, length: int, bins: int = 8) -> DataFrame:
    """bin, n, pct of positions below length, bins of equal width, empty ones too."""
    width = length // bins
    spark = rows.sparkSession
    counts = rows.groupBy(F.least(F.expr(f"pos div {width}"), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))
    out = spark.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left").fillna(0, ["n"])
    return out.withColumn("pct", F.round(100 * F.col("n") / width, 4))


def reference_counts(lists: DataFrame, length: int) -> DataFrame:
    """pos, n: how many lists (array ``idx``) select each position below length, 0 included."""
    counts = lists.select(F.explode("idx").alias("pos")).groupBy("pos").agg(F.count("*").alias("n"))
    return lists.sparkSession.range(length).withColumnRenamed("id", "pos").join(counts, "pos", "left").fillna(0, ["n"])


def correlation(rows: DataFrame, x: str, y: str) -> DataFrame:
    """r of the rows that have both values: Pearson's coefficient, NaN where either does not vary, null without such rows."""
    both = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    # corr itself divides by the deviations, which is an error where they are zero.
    facts = both.agg(
        F.covar_pop(x, y).alias("shared"), (F.stddev_pop(x) * F.stddev_pop(y)).alias("scale"), ((F.min(x) == F.max(x)) | (F.min(y) == F.max(y))).alias("still")
    )
    return facts.select(F.when(F.col("still") | (F.col("scale") == 0), F.lit(float("nan"))).otherwise(F.col("shared") / F.col("scale")).alias("r"))


def boundary_stats(rows: DataFrame, edge: int) -> DataFrame:
    """Positions before the edge and behind it: n, mean and greatest error."""
    part = F.when(F.col("pos") < edge, "boundary").otherwise("interior")
    return rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.round(F.avg("err"), 6).alias("mean_err"), F.max("err").alias("max_err"))


def speedups(rows: DataFrame, baseline: str) -> DataFrame:
    """name, ms, speedup against the baseline's mean."""
    base = rows.filter(F.col("name") == baseline).select(F.col("ms").alias("_base")).limit(1)
    return rows.join(F.broadcast(base)).select("name", "ms", F.round(F.col("_base") / F.col("ms"), 6).alias("speedup"))


def shares(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, total and percent of the whole, of positive totals."""
    sums = rows.groupBy(key).agg(F.sum(value).alias("total")).filter("total > 0")
    return sums.withColumn("pct", F.round(100 * F.col("total") / F.greatest(F.sum("total").over(Window.partitionBy()), F.lit(1)), 4))


def state_bytes(rows: DataFrame, block: int = 256) -> DataFrame:
    """Optimizer bytes by name for parameters (name, numel, is_fallback): quantised momentum with one scale per block for
    matrices, two fp32 states and a master copy for the others."""
    n = F.col("numel")
    quantised = n + F.expr(f"(numel + {block} - 1) div {block}") * DTYPE_BYTES["fp32"]
    fallback = n * (2 * DTYPE_BYTES["fp32"] + DTYPE_BYTES["fp32"])
    return rows.select("name", (n * DTYPE_BYTES["bf16"]).alias("model_bytes"), (n * DTYPE_BYTES["fp32"]).alias("grad_bytes"), F.when(F.col("is_fallback"), fallback).otherwise(quantised).alias("state_bytes"))


def copy_breakdown(counters: DataFrame, events: DataFrame, declared: DataFrame) -> DataFrame:
    """Copies of 8-bit tensors by source, one row per run of ``counters`` (run, counters: a map).

    ``events`` (run, kind dgrad or wgrad, converted_a, total_a, converted_b, total_b) are grouped calls; without any, their
    numbers come from the counters and their copies from the number of experts: the one observed group size, else the
    declared one.  Dense copies are what the copy counter leaves, or, without it, what the adapter's hits call for.
    """
    at = lambda k: F.coalesce(F.try_element_at("counters", F.lit(k)), F.lit(0))
    own = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0))
    copied = F.col("converted_a") + F.col("converted_b")
    seen = events.groupBy("run").agg(
        own("dgrad", F.lit(1)).alias("e_dgrad"), own("wgrad", F.lit(1)).alias("e_wgrad"), own("dgrad", copied).alias("c_dgrad"), own("wgrad", copied).alias("c_wgrad"), F.count("*").alias("n_events"),
    )
    sizes = events.select("run", F.explode(F.array("total_a", "total_b")).alias("size"))
    experts = inferred_experts(declared, sizes).select("run", F.col("used").alias("experts"))
    rows = counters.join(seen, "run", "left").join(experts, "run", "left")
    some = F.coalesce("n_events", F.lit(0)) > 0
    kinds = ("dgrad", "wgrad")
    rows = rows.withColumns({f"grouped_{k}": F.when(some, F.col(f"e_{k}")).otherwise(at(f"mxfp8_grouped_transpose_copy_fallback_{k}")) for k in kinds})
    inferred = {"dgrad": F.col("grouped_dgrad") * F.col("experts"), "wgrad": F.col("grouped_wgrad") * F.col("experts") * 2}
    rows = rows.withColumns({f"copies_{k}": F.when(some, F.col(f"c_{k}")).otherwise(F.coalesce(inferred[k], F.lit(0))) for k in kinds})
    rows = rows.withColumns({f"dense_{k}": F.greatest(at(f"mxfp8_tn_adapter_{k}") - F.col(f"grouped_{k}"), F.lit(0)) for k in kinds})
    rows = rows.withColumns({"grouped_copies": F.expr("copies_dgrad + copies_wgrad"), "dense_expected": F.expr("dense_dgrad + 2 * dense_wgrad"), "total": F.try_element_at("counters", F.lit("mxfp8_tn_adapter_copy_transpose"))})
    source = F.when(some, "counted").when(F.col("experts").isNotNull(), "inferred").otherwise("none")
    return rows.select(
        "run", "total", "grouped_copies", F.when(F.col("total").isNull(), F.col("dense_expected")).otherwise(F.greatest(F.expr("total - grouped_copies"), F.lit(0))).alias("dense_copies"),
        F.expr("grouped_dgrad + grouped_wgrad").alias("grouped_hits"), F.expr("dense_dgrad + dense_wgrad").alias("dense_hits"), F.expr("total - grouped_copies - dense_expected").alias("unattributed"), source.alias("source"),
    )


def descendants(edges: DataFrame, root: str) -> DataFrame:
    """node, depth of everything below the root of (parent, child), each node once with its least depth; edges may form cycles.

    Each level is stored, and leaves out what a level before has, so every edge is followed once; at most as many levels as
    the longest shortest path.
    """
    spark, path = edges.sparkSession, scratch_path(edges.sparkSession, "descendants")
    pairs, schema, depth = edges.select("parent", "child").distinct(), "node string, depth int", 0
    spark.createDataFrame([(root,)], "node string").write.parquet(f"{path}/depth=0")
    while True:
        seen = spark.read.schema(schema).parquet(path)
        front = seen.filter(F.col("depth") == depth)
        if not front.limit(1).count():
            return seen
        found = pairs.join(front, F.col("parent") == F.col("node")).select(F.col("child").alias("node")).distinct()
        depth += 1
        found.join(seen.select("node"), "node", "left_anti").write.parquet(f"{path}/depth={depth}")


def flattened(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """path and value (as text) of every leaf of a column nested to any depth: fields of structs and keys of maps are joined by
    dots after the prefix; nulls give no leaf."""

    def leaves(value: Column, path: Column, kind: DataType) -> Column:
        if isinstance(kind, StructType):
            parts = [leaves(value[f.name], F.concat_ws(".", path, F.lit(f.name)), f.dataType) for f in kind.fields]
            return F.when(value.isNotNull(), F.flatten(F.array(*parts)))
        if isinstance(kind, MapType):
            inner = F.transform(F.map_entries(value), lambda e: leaves(e["value"], F.concat_ws(".", path, e["key"].cast("string")), kind.valueType))
            return F.flatten(F.filter(inner, lambda x: x.isNotNull()))
        return F.when(value.isNotNull(), F.array(F.struct(path.alias("path"), value.cast("string").alias("value")))).otherwise(F.array().cast("array<struct<path:string,value:string>>"))

    found = leaves(F.col(column), F.lit(prefix), rows.schema[column].dataType)
    return rows.select(F.explode(found).alias("leaf")).select("leaf.path", "leaf.value")
