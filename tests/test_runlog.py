"""Golden figures of small logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.scalars import coerced, duration_ms, finite, label_path, readable_bytes, short
from corpusmill.operators import profiler, runlog
from corpusmill.plans import QUERIES
from corpusmill.sources import logs


def _step(it: int, ms: float, skipped: int = 0) -> str:
    return (
        f" iteration {it:8d}/      10 | consumed samples: {it * 2} | elapsed time per iteration (ms): {ms} | learning rate: 1E-4 | global batch size:     2 | "
        f"lm loss: 1.5E+00 | mtp_1 loss: 2.5 | mtp_2 loss: 3.5 | number of skipped iterations: {skipped} | number of nan iterations: 0 |"
    )


def _lines(spark, run: str, lines: list[str]):
    return spark.createDataFrame([(run, i, v) for i, v in enumerate(lines)], "run string, line_no int, value string")


def test_both_rates(spark) -> None:
    lines = _lines(spark, "a", ["  seq_length ........ 1024", _step(1, 4000.0), _step(2, 1000.0), _step(3, 500.0)])
    row = runlog.summary(runlog.steps(lines), runlog.seq_length(lines), start=2).first()
    assert (row.avg_ms, row.hot_steps, row.tokens_per_step) == (750.0, 2, 2048)
    assert row.tok_s_mean == 3072.0
    assert row.tok_s_ratio == 2730.666667


def test_second_run_and_delta(spark) -> None:
    a = _lines(spark, "a", ["  seq_length ........ 1024", _step(1, 4000.0), _step(2, 1000.0), _step(3, 500.0)])
    b = _lines(spark, "b", ["  seq_length ........ 1024", _step(1, 5000.0), _step(2, 2000.0), _step(3, 1000.0, 1)])
    lines = a.unionByName(b)
    out = runlog.summary(runlog.steps(lines), runlog.seq_length(lines), start=2)
    rows = {r.run: r for r in out.collect()}
    assert (rows["b"].avg_ms, rows["b"].tok_s_mean, rows["b"].skipped) == (1500.0, 1536.0, 1)
    delta = {r.run: r.tok_s_mean_pct for r in runlog.against_baseline(out, "b", ["tok_s_mean"]).collect()}
    assert delta == {"a": 100.0, "b": 0.0}
    assert {r.warning for r in runlog.warnings(out).collect()} == {"1 skipped iterations"}


def test_empty_window_is_null(spark) -> None:
    lines = _lines(spark, "a", [_step(1, 4000.0)])
    row = runlog.summary(runlog.steps(lines), runlog.seq_length(lines), start=3).first()
    assert (row.hot_steps, row.avg_ms, row.tok_s_mean, row.tok_s_ratio) == (0, None, None, None)


def test_extra_losses_and_memory(spark) -> None:
    lines = _lines(spark, "a", [
        _step(1, 10.0), "[mem_profile] setup: alloc=3.0 GiB reserved=4.0 GiB max_alloc=3.5 GiB max_reserved=4.5 GiB",
        "[Rank 0] (after 1 iterations) memory (MB) | allocated: 1024 | max allocated: 9216 | reserved: 1 | max reserved: 2",
    ])
    assert {(r.name, r.loss) for r in runlog.extra_losses(lines).collect()} == {("mtp_1", 2.5), ("mtp_2", 3.5)}
    row = runlog.memory_summary(runlog.memory(lines), "setup").first()
    assert (row.setup_gib, row.max_gib) == (3.0, 9.0)


def test_storage_section(spark) -> None:
    lines = _lines(spark, "a", ["[mem_profile] early 5 elems 1.0 GiB", "[mem_profile] by_storage:", "[mem_profile]  MXFP8Tensor   1,024 elems   0.001 GiB", "[mem_profile] top_parameters:", "[mem_profile] late 5 elems 1.0 GiB"])
    assert [(r.storage, r.numel, r.bytes) for r in runlog.storage(lines).collect()] == [("MXFP8Tensor", 1024, 1073742)]


def test_log_files(spark, tmp_path) -> None:
    (tmp_path / "x.log").write_bytes(b"one\r\n\xff two\nthree\n")
    rows = logs.log_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.run, r.line_no, r.value) for r in rows] == [("x.log", 0, "one"), ("x.log", 1, "� two"), ("x.log", 2, "three")]
    assert [r.value for r in logs.tail(logs.log_lines(spark, str(tmp_path)), 2).collect()] == ["� two", "three"]


def test_trace_ids_and_unlinked(spark) -> None:
    schema = "ord long, cat string, name string, dur double, ext_id string, input_types array<string>, input_dims array<string>"
    rows = [
        (1, "cpu_op", "aten::mm", 5.0, "7", ["bf16"], ["2x2"]), (2, "cpu_op", "outer", 50.0, "7", [], []), (3, "kernel", "nvjet_sm121_x", 100.0, "7", [], []),
        (4, "kernel", "mxfp8_gemm", 200.0, None, [], []), (5, "kernel", "elementwise", 1.0, "7", [], []),
    ]
    out = {(r.kind, r.cpu_op, r.calls, r.total_us) for r in profiler.trace_groups(spark.createDataFrame(rows, schema)).collect()}
    assert out == {("nvjet_sm121_tc", "aten::mm", 1, 100.0), ("flashinfer_mxfp8_cutlass", "<unlinked>", 1, 200.0)}


def test_scalars(spark) -> None:
    one = spark.range(1)
    at = lambda c: one.select(c.alias("x")).first().x
    assert at(duration_ms(F.lit("12.5us"))) == 0.0125
    assert at(duration_ms(F.lit("12.5"))) is None
    assert at(readable_bytes(F.lit(250_000_000))) == "0.250 GB"
    assert at(readable_bytes(F.lit(None).cast("long"))) == "-"
    assert at(short(F.lit("abcdefgh"), 6)) == "abc..."
    assert at(label_path(F.lit("=x"))) is None
    assert at(label_path(F.lit("a=b=c"))).path == "b=c"
    assert at(finite(F.lit(float("nan")), 3)) is None
    assert [at(coerced(F.lit(v))) for v in ("1", "1.5", "x")] == ["int", "float", "error"]


def test_log_files_beyond_a_bigint(spark, tmp_path) -> None:
    big = 2 * 10**18
    spark.createDataFrame([(big + i, "F") for i in range(3)], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    row = QUERIES["runlog_files"](spark, str(tmp_path)).first()
    assert (row.part, row.n, row.keys, int(row.placed)) == ("F", 3, 3 * big + 3, 2 * (big + 1) + 4 * (big + 2))


def test_table_lines_are_split_once(spark) -> None:
    for read in (profiler.torch_table, profiler.kernel_table, profiler.memory_operations):
        plan = read(_lines(spark, "a", ["x"]))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
