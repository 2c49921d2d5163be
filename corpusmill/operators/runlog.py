"""Run logs: step, memory and counter lines to typed rows, summaries, comparisons and warnings.

Lines are rows (run, line_no, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.scalars import GIB, MIB, NUMBER, delta, delta_percent, extract, gib_to_bytes
from corpusmill.sources.logs import section

# The forms of log lines.
STEP = (
    r"iteration\s+(\d+)\s*/\s*(\d+).*?consumed samples:\s*(\d+).*?elapsed time per iteration \(ms\):\s*(" + NUMBER + r").*?"
    r"global batch size:\s*(\d+).*?lm loss:\s*(" + NUMBER + r").*?number of skipped iterations:\s*(\d+).*?number of nan iterations:\s*(\d+)"
)
GPU_STEP = (
    r"iteration\s+(\d+)/\s*(\d+).*?elapsed time per iteration \(ms\):\s*([\d.]+).*?throughput per GPU \(TFLOP/s/GPU\):\s*([\d.]+).*?"
    r"lm loss:\s*([\d.eE+-]+).*?grad norm:\s*([\d.eE+-]+|inf|nan)"
)
MTP = r"\b(mtp_\d+)\s+loss:\s*(" + NUMBER + ")"
MEMORY_GIB = (
    r"\[mem_profile\]\s+([^:]+):\s+alloc=(" + NUMBER + r")\s+GiB\s+reserved=(" + NUMBER + r")\s+GiB\s+max_alloc=(" + NUMBER + r")\s+GiB\s+max_reserved=(" + NUMBER + r")\s+GiB"
)
MEMORY_MB = r"\[Rank\s+\d+\].*?memory \(MB\) \| allocated:\s*(" + NUMBER + r") \| max allocated:\s*(" + NUMBER + r") \| reserved:\s*(" + NUMBER + r") \| max reserved:\s*(" + NUMBER + ")"
SEQ_LENGTH = (r"^\s*seq_length\s+\.+\s+(\d+)\s*$", r"^\s*max_position_embeddings\s+\.+\s+(\d+)\s*$", r"\[local-quarter\].*?\bseq(?:_length)?=(\d+)")
STORAGE = r"\[mem_profile\]\s+(.+?)\s+([\d,]+)\s+elems\s+(" + NUMBER + r")\s+GiB"
CUPTI = "CUPTI_ERROR_MULTIPLE_SUBSCRIBERS_NOT_SUPPORTED"


def _typed(lines: DataFrame, pattern: str, fields: list[tuple[str, str]]) -> DataFrame:
    """run, line_no, value and the typed groups of the lines that match."""
    found = lines.filter(F.col("value").rlike(pattern))
    return found.select("run", "line_no", "value", *[F.regexp_extract("value", pattern, i).try_cast(t).alias(n) for i, (n, t) in enumerate(fields, 1)])


def steps(lines: DataFrame) -> DataFrame:
    """One row per step line; lines that lack a part are left out."""
    return _typed(lines, STEP, [
        ("iteration", "int"), ("total_iterations", "int"), ("consumed_samples", "long"), ("elapsed_ms", "double"), ("global_batch_size", "int"),
        ("lm_loss", "double"), ("skipped_iterations", "int"), ("nan_iterations", "int"),
    ])


def gpu_steps(lines: DataFrame) -> DataFrame:
    """The step form with throughput and gradient norm; the norm stays text, for it can be inf or nan."""
    return _typed(lines, GPU_STEP, [("iteration", "int"), ("total_iterations", "int"), ("elapsed_ms", "double"), ("tflops", "double"), ("lm_loss", "double"), ("grad_norm", "string")])


def extra_losses(lines: DataFrame) -> DataFrame:
    """run, line_no, name, loss of every further loss on step lines."""
    names = F.regexp_extract_all("value", F.lit(MTP), F.lit(1))
    values = F.regexp_extract_all("value", F.lit(MTP), F.lit(2))
    pairs = F.arrays_zip(names.alias("name"), values.alias("loss"))
    found = lines.filter(F.col("value").rlike(STEP)).select("run", "line_no", F.explode(pairs).alias("p"))
    return found.select("run", "line_no", F.col("p.name").alias("name"), F.col("p.loss").try_cast("double").alias("loss"))


def memory(lines: DataFrame) -> DataFrame:
    """Memory lines of both forms in GiB; a line of the first form is not read as the second."""
    value = F.col("value")
    first = value.rlike(MEMORY_GIB)
    found = lines.filter(first | value.rlike(MEMORY_MB))

    def either(gib: int, mb: int) -> Column:
        small = F.regexp_extract(value, MEMORY_MB, mb).try_cast("double") * MIB / GIB
        return F.when(first, F.regexp_extract(value, MEMORY_GIB, gib).try_cast("double")).otherwise(small)

    return found.select(
        "run", "line_no", F.when(first, F.regexp_extract(value, MEMORY_GIB, 1)).otherwise("rank_memory").alias("tag"),
        either(2, 1).alias("alloc_gib"), either(3, 3).alias("reserved_gib"), either(4, 2).alias("max_alloc_gib"), either(5, 4).alias("max_reserved_gib"),
    )


def seq_length(lines: DataFrame) -> DataFrame:
    """run, seq_length: by the first pattern that matches anywhere, there the first line."""
    ranked = F.array_compact(F.array(*[
        F.when(F.col("value").rlike(p), F.struct(F.lit(i).alias("priority"), F.col("line_no"), F.regexp_extract("value", p, 1).try_cast("int").alias("length")))
        for i, p in enumerate(SEQ_LENGTH)
    ]))
    found = lines.select("run", F.explode(ranked).alias("m"))
    return found.groupBy("run").agg(F.min("m").alias("m")).select("run", F.col("m.length").alias("seq_length"))


def storage(lines: DataFrame) -> DataFrame:
    """run, storage, numel, bytes of the lines in the storage section; of repeated kinds the last line counts."""
    inside = section(lines, F.col("value").startswith("[mem_profile] by_storage:"), F.col("value").startswith("[mem_profile] top_parameters:"))
    rows = inside.filter(F.col("value").rlike(STORAGE)).select(
        "run", "line_no", F.trim(F.regexp_extract("value", STORAGE, 1)).alias("storage"),
        F.regexp_replace(F.regexp_extract("value", STORAGE, 2), ",", "").try_cast("long").alias("numel"),
        gib_to_bytes(F.regexp_extract("value", STORAGE, 3).try_cast("double")).alias("bytes"),
    )
    last = F.max_by(F.struct("numel", "bytes"), "line_no").alias("m")
    return rows.groupBy("run", "storage").agg(last).select("run", "storage", "m.numel", "m.bytes")


def hot(step_rows: DataFrame, start: int = 3, end: int | None = None) -> DataFrame:
    """The steps of the steady window, both ends included."""
    keep = F.col("iteration") >= start
    return step_rows.filter(keep if end is None else keep & (F.col("iteration") <= end))


def summary(step_rows: DataFrame, lengths: DataFrame, start: int = 3, end: int | None = None) -> DataFrame:
    """One row per run.

    ``final_loss`` and the batch size come from the last parsed line.  ``tok_s_mean`` is the mean of the steps' rates,
    ``tok_s_ratio`` the tokens of a step by the mean time; both are null without steps in the window.
    """
    last = step_rows.groupBy("run").agg(
        F.max_by("global_batch_size", "line_no").alias("gbs"), F.max_by("lm_loss", "line_no").alias("final_loss"),
        F.count("*").alias("n_steps"), F.sum("skipped_iterations").alias("skipped"), F.sum("nan_iterations").alias("nans"),
    )
    base = last.join(lengths, "run", "left").withColumn("tokens_per_step", (F.col("gbs") * F.col("seq_length")).cast("long"))
    window = hot(step_rows, start, end).select("run", "elapsed_ms").join(base.select("run", "tokens_per_step"), "run")
    means = window.groupBy("run").agg(
        F.count("*").alias("hot_steps"), F.avg("elapsed_ms").alias("avg_ms"), F.avg(F.col("tokens_per_step") / (F.col("elapsed_ms") / 1000)).alias("tok_s_mean"),
    )
    out = base.join(means, "run", "left")
    return out.select(
        "run", "n_steps", F.coalesce("hot_steps", F.lit(0)).alias("hot_steps"), F.round("avg_ms", 6).alias("avg_ms"), "tokens_per_step",
        F.round("tok_s_mean", 6).alias("tok_s_mean"), F.round(F.col("tokens_per_step") / (F.col("avg_ms") / 1000), 6).alias("tok_s_ratio"),
        F.round(F.col("avg_ms") / F.col("tokens_per_step"), 12).alias("ms_per_token"), "final_loss", "skipped", "nans",
    )


def memory_summary(rows: DataFrame, tag: str) -> DataFrame:
    """run, setup_gib (the first line of the tag), max_gib."""
    setup = F.min_by(F.col("alloc_gib"), F.when(F.col("tag") == tag, F.col("line_no"))).alias("setup_gib")
    return rows.groupBy("run").agg(setup, F.max("max_alloc_gib").alias("max_gib"))


def against_baseline(summaries: DataFrame, baseline: str, metrics: list[str]) -> DataFrame:
    """Each run's difference to the baseline run, absolute and in percent; the baseline is one row, so it is broadcast."""
    base = summaries.filter(F.col("run") == baseline).select(*[F.col(m).alias(f"_{m}") for m in metrics]).limit(1)
    rows = summaries.join(F.broadcast(base))
    pairs = [c for m in metrics for c in (delta(F.col(m), F.col(f"_{m}")).alias(f"{m}_delta"), delta_percent(F.col(m), F.col(f"_{m}")).alias(f"{m}_pct"))]
    return rows.select("run", *pairs)


def side_by_side(rows: DataFrame, left: str, right: str, key: str, value: str) -> DataFrame:
    """key, left and right values: all keys of both runs, null where one lacks it."""
    side = lambda run, name: rows.filter(F.col("run") == run).select(key, F.col(value).alias(name))
    return side(left, "left_value").join(side(right, "right_value"), key, "full_outer")


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def orphans(named: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``named`` that ``known`` lacks."""
    return named.select(key).distinct().join(known.select(key), key, "left_anti")


def with_missing(live: DataFrame, processes: DataFrame, key: str) -> DataFrame:
    """``live`` with reachable = true, and the processes that are not among them with false and nulls."""
    rest = processes.join(live.select(key), key, "left_anti").withColumn("reachable", F.lit(False))
    return live.withColumn("reachable", F.lit(True)).unionByName(rest, allowMissingColumns=True)


def warnings(summaries: DataFrame) -> DataFrame:
    """run and warning, one row each."""
    texts = F.array_compact(F.array(
        F.when(F.col("hot_steps") < 2, "fewer than two steady steps"),
        F.when(F.col("skipped") > 0, F.concat(F.col("skipped").cast("string"), F.lit(" skipped iterations"))),
        F.when(F.col("nans") > 0, F.concat(F.col("nans").cast("string"), F.lit(" nan iterations"))),
        F.when(F.col("tokens_per_step").isNull(), "tokens per step unknown"),
    ))
    return summaries.select("run", F.explode(texts).alias("warning"))


def artifact_warnings(named: DataFrame, known: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """run, warning: of artifacts a run names (run, path, kind) how many are not among the known paths, and each of the ``kinds``
    that a run has none of."""
    runs = named.select("run").distinct()
    gone = named.join(known.select("path").distinct(), "path", "left_anti").groupBy("run").agg(F.count("*").alias("n"))
    missing = gone.select("run", F.concat(F.col("n").cast("string"), F.lit(" artifacts do not exist")).alias("warning"))
    each = runs.withColumn("kind", F.explode(F.array(*map(F.lit, kinds)))).join(named.select("run", "kind").distinct(), ["run", "kind"], "left_anti")
    return missing.unionByName(each.select("run", F.concat(F.lit("no "), "kind", F.lit(" found")).alias("warning")))


def token_warnings(summaries: DataFrame, profiles: DataFrame) -> DataFrame:
    """run, warning where the tokens of a step by the log are not those by the profile (run, batch, length); profiles stand in for
    logs that do not tell."""
    both = summaries.join(profiles, "run").filter((F.col("tokens_per_step") != F.col("batch") * F.col("length")))
    told = F.concat_ws(" ", F.lit("log says"), F.col("tokens_per_step").cast("string"), F.lit("tokens a step, profile"), (F.col("batch") * F.col("length")).cast("string"))
    return both.select("run", told.alias("warning"))


def log_warnings(lines: DataFrame) -> DataFrame:
    """Runs whose log says that two profilers ran at once."""
    return lines.filter(F.contains(F.col("value"), F.lit(CUPTI))).select("run").distinct().withColumn("warning", F.lit("two profilers in one run"))


def artifacts(lines: DataFrame, pattern: str) -> DataFrame:
    """run, kind (the suffix), n_paths and the sorted paths named in the log, each once."""
    paths = lines.select("run", F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("path")).distinct()
    kind = F.substring_index("path", ".", -1).alias("kind")
    return paths.groupBy("run", kind).agg(F.count("*").alias("n_paths"), F.array_join(F.array_sort(F.collect_list("path")), ",").alias("paths"))


def repeated_labels(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).count().filter("count > 1").withColumnRenamed("count", "n")


def profile_group(stem: Column) -> Column:
    """struct(prefix, date) of a log name such as run_20260427."""
    pattern = r"^(.*?)[_-]?(\d{8})"
    return F.struct(extract(stem, pattern, 1).alias("prefix"), extract(stem, pattern, 2).alias("date"))
