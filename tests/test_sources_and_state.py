"""Unit cases of sources, sinks, numbering, graphs and streaming state."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import arrays
from corpusmill.operators import audit, ordinals, runlog, sequence
from corpusmill.sources import logs, packed, sinks


def test_log_lines_over_many_splits(spark, tmp_path) -> None:
    lines = {f"run{k}.log": [f"line {i} of {k}" if i % 4 else "" for i in range(200 + k)] for k in range(3)}
    for name, text in lines.items():
        (tmp_path / name).write_bytes(("\r\n" if name == "run1.log" else "\n").join(text).encode() + b"\n\xff tail")
    small = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        got = sorted((r.run, r.line_no, r.value) for r in logs.log_lines(spark, str(tmp_path)).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [(n, i, t) for n, text in lines.items() for i, t in enumerate([*text, "� tail"]) if t]
    assert got == sorted(want)


def test_row_numbers_and_sparse_keys(spark) -> None:
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(1 << 60), 1 << 60, 3000)).tolist()
    df = spark.createDataFrame([(k, f"{k % 977:04d}") for k in keys], "k long, name string").repartition(5)
    assert {r.k: r.ord for r in ordinals.ordinals(df, "k").collect()} == {k: i for i, k in enumerate(keys)}
    assert ordinals.block_width(df, "k", 100) > 1 << 50
    got = sorted((r.ord, r.name) for r in ordinals.row_numbers(df, ["name", "k"]).collect())
    assert [g[0] for g in got] == list(range(len(keys))) and [g[1] for g in got] == sorted(g[1] for g in got)
    assert ordinals.row_numbers(df.filter("k is null"), ["name"]).count() == 0
    assert ordinals.ordinals(df.filter("k is null"), "k").count() == 0


def test_descendants_of_a_cycle_and_of_a_long_chain(spark) -> None:
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("x", "y"), ("a", None)], "parent string, child string")
    assert sorted((r.node or "", r.depth) for r in audit.descendants(loop, "a").collect()) == [("", 1), ("a", 0), ("b", 1), ("c", 2)]


def test_flattened_to_any_depth(spark) -> None:
    df = spark.sql("select named_struct('a', map('x', named_struct('p', 1, 'q', null), 'y', null), 'b', 2.5) as s union all select null")
    assert sorted((r.path, r.value) for r in audit.flattened(df, "s", "root").collect()) == [("root.a.x.p", "1"), ("root.b", "2.5")]


def test_copy_breakdown_without_counters(spark) -> None:
    counters = spark.createDataFrame([("a", {}), ("b", {"mxfp8_tn_adapter_wgrad": 3})], "run string, counters map<string,bigint>")
    events = spark.createDataFrame([("b", "wgrad", 2, 4, 1, 4)], "run string, kind string, converted_a int, total_a int, converted_b int, total_b int")
    out = {r.run: r for r in audit.copy_breakdown(counters, events, counters.select("run", F.lit(None).cast("int").alias("declared"))).collect()}
    assert (out["a"].source, out["a"].dense_copies, out["a"].total) == ("none", 0, None)
    assert (out["b"].source, out["b"].grouped_copies, out["b"].dense_copies) == ("counted", 3, 4)


def test_shards_are_read_back(spark, tmp_path) -> None:
    rows = spark.range(100).selectExpr("id as doc_id", "concat('t', id) as text", "id div 30 as shard", "if(id >= 95, 'val', 'train') as part")
    done = sinks.write_shards(rows, str(tmp_path / "s")).first()
    assert (done.n_shards, done.n_train, done.n_val, done.total) == (4, 95, 5, 100)
    assert len(list((tmp_path / "s").glob("part=*/shard=*/*.parquet"))) == 5


def test_publish_needs_exactly_one(spark, tmp_path) -> None:
    for folders in ([], [("a",), ("b",)]):
        with pytest.raises(ValueError, match="exactly one"):
            sinks.publish_one(spark.createDataFrame(folders, "folder string"), str(tmp_path / "p"), "k", "n long, k string")


def test_components_by_name() -> None:
    assert arrays.parsed_components("core") == ("structure", "dep_level")
    assert arrays.parsed_components(" ast_depth, structure") == ("structure", "ast_depth")
    with pytest.raises(ValueError, match="no such"):
        arrays.parsed_components("structure,other")


def test_eight_bit_floats(spark) -> None:
    x = [0.0, 448.0, 1000.0, -0.017, 1.0625, 1.1875, 2.0**-9, 2.0**-10, 3 * 2.0**-10]
    got = spark.createDataFrame([(v,) for v in x], "x double").select(arrays.e4m3_rounded(F.col("x")).alias("y"))
    assert [r.y for r in got.collect()] == [0.0, 448.0, 448.0, -0.017578125, 1.0, 1.25, 2.0**-9, 0.0, 2.0**-8]


def test_folds_carry_on_over_batches(spark) -> None:
    rows = spark.range(3000).selectExpr("id % 2 as id", "id as pos", "1.0D as x", "0.5D as f", "0.0D as w")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        ends = sequence.folded(rows, "id", "pos", ["x"], lambda s, x: (s or 0.0) + x, "id long, pos long, state double").groupBy("id").agg(F.max("state").alias("n"))
        assert {r.id: r.n for r in ends.collect()} == {0: 1500.0, 1: 1500.0}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_artifact_warnings(spark) -> None:
    named = spark.createDataFrame([("a", "x.csv", "csv"), ("a", "y.txt", "txt"), ("b", "z.csv", "csv")], "run string, path string, kind string")
    known = spark.createDataFrame([("x.csv",), ("z.csv",)], "path string")
    got = {(r.run, r.warning) for r in runlog.artifact_warnings(named, known, ("csv", "txt")).collect()}
    assert got == {("a", "1 artifacts do not exist"), ("b", "no txt found")}


@pytest.mark.parametrize("checksums", [True, False])
def test_a_broken_shard_is_found_and_deleted(spark, tmp_path, checksums: bool) -> None:
    rows = spark.range(4000).selectExpr("id as doc_id", "sha2(cast(id as string), 256) as text", "id div 1000 as shard", "'train' as part")
    path = tmp_path / "s"
    sinks.write_shards(rows, str(path))
    assert sinks.check_shards(rows, str(path)).agg(F.sum("m")).first()[0] == 4000
    (file,) = (path / "part=train" / "shard=2").glob("*.parquet")
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1  # in a page of text
    file.write_bytes(data)
    if not checksums:
        (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(ValueError, match="shard=2: the shard does not read back"):
        sinks.check_shards(rows, str(path))
    assert sorted(p.name for p in (path / "part=train").iterdir()) == ["shard=0", "shard=1", "shard=3"]


def test_pairs_join_to_one(spark, tmp_path, monkeypatch) -> None:
    monkeypatch.setattr(packed, "SPAN", 64)
    monkeypatch.setattr(packed, "CHUNK", 16)
    packed.register(spark)
    lists = [[k * 7 + j for j in range(k % 9)] for k in range(200)]
    frame = spark.createDataFrame([(v,) for v in lists], "tokens array<long>").repartition(5)
    frame.write.format("packed_tokens").option("dtype", "uint16").mode("append").save(str(tmp_path / "parts"))
    (tmp_path / "one").mkdir()
    n = packed.join(spark, str(tmp_path / "parts"), str(tmp_path / "one" / "all"))
    assert n == sum(bool(v) for v in lists) and sorted(p.name for p in (tmp_path / "one").iterdir()) == ["all.bin", "all.idx"]
    data = (tmp_path / "one" / "all.idx").read_bytes()
    dtype, sizes, pointers = packed.read_index(data)
    assert dtype == "uint16" and len(sizes) == n and pointers.tolist() == (2 * (np.cumsum(sizes) - sizes)).tolist()
    assert np.frombuffer(data[-8 * (n + 1) :], "<i8").tolist() == list(range(n + 1))
    read = lambda p: [r.tokens for r in spark.read.format("packed_tokens").load(str(tmp_path / p)).orderBy("part", "doc_idx").collect()]
    assert read("one") == read("parts") and sorted(read("one")) == sorted(v for v in lists if v)
    with pytest.raises(Exception, match="do not fit uint16"):
        spark.createDataFrame([([70_000],)], "tokens array<long>").write.format("packed_tokens").option("dtype", "uint16").mode("append").save(str(tmp_path / "wide"))
    assert not list((tmp_path / "wide").glob("*.idx"))
