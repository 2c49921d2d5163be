"""Unit cases of corpus, history, audit and sequence operators."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import arrays
from corpusmill.operators import audit, corpus, history, ordinals, sequence
from corpusmill.sources import packed
from corpusmill.streaming import jobs


def _ids(spark, n: int):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def test_packed_index(spark) -> None:
    lists = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None), (4, [4])], "doc_id long, tokens array<long>").select("doc_id", F.size("tokens").alias("size")).filter("size > 0")
    assert [(r.size, r.pointer) for r in corpus.packed_index(lists).orderBy("ord").collect()] == [(3, 0), (1, 12)]
    assert sorted(r.doc_idx for r in corpus.document_index(lists).collect()) == [0, 1, 2]


def test_prefix_sum_over_blocks(spark) -> None:
    rows = spark.range(1000).withColumn("v", F.col("id") % 7)
    out = ordinals.prefix_sum(rows, "id", F.col("v"), "p", block=64).orderBy("id").collect()
    want = np.concatenate([[0], np.cumsum(np.arange(1000) % 7)[:-1]])
    assert [r.p for r in out] == want.tolist()


@pytest.mark.parametrize(("total", "shards", "train", "val"), [(25, 3, 24, 1), (20, 2, 20, 0), (0, 0, 0, 0), (21, 3, 21, 0)])
def test_tail_split(spark, total: int, shards: int, train: int, val: int) -> None:
    row = corpus.shard_sentinel(corpus.shard_plan(_ids(spark, total), 10)).first()
    assert (row.n_shards, row.n_train, row.n_val) == (shards, train, val)


def test_split_rule(spark) -> None:
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "f string")
    rule = lambda df, **k: {(r.shard, r.in_train, r.in_val) for r in corpus.split_rule(df, "f", "val", **k).collect()}
    assert rule(names("a", "b", "c")) == {("a", True, False), ("b", True, False), ("c", False, True)}
    assert rule(names("a")) == {("a", True, True)}
    assert rule(names("a"), strict=True) == {("a", False, True)}
    assert rule(names("a", "z", "val")) == {("a", True, False), ("z", True, False), ("val", False, True)}


def test_history_edges(spark) -> None:
    schema = "port long, ord long, step long, loss double, ts timestamp"
    rows = [(1, 0, 5, 2.0, None), (1, 1, 5, 3.0, None), (1, 2, 6, None, None), (1, 3, 5, 1.0, None), (2, 0, 1, 1.0, None)]
    df = spark.createDataFrame(rows, schema)
    assert [r.ord for r in history.changed(df).filter("port = 1").orderBy("ord").collect()] == [0, 2, 3]
    ema = [r.ema for r in history.smoothed(df.filter("port = 1"), 0.5).orderBy("ord").collect()]
    assert ema == [2.0, 2.5, None, 1.75]
    line = {r.port: (r.slope, r.intercept) for r in history.regression(df.filter("step = 5 or port = 2"), "step", "loss").collect()}
    assert line == {1: (0.0, 2.0), 2: (0.0, 1.0)}
    assert [r.port for r in history.trends(df).collect()] == [1]


def test_replay(spark) -> None:
    schema = "device int, idx long, action string, size long, addr long"
    rows = [(0, 0, "alloc", 10, 1), (0, 1, "alloc", 20, 2), (0, 2, "free_completed", 99, 1), (0, 3, "alloc", 5, 3), (1, 0, "free_completed", 7, 0), (1, 1, "alloc", 3, 0)]
    out = {r.device: (r.peak, r.peak_idx, r.live_end) for r in audit.replay(spark.createDataFrame(rows, schema)).collect()}
    assert out == {0: (30, 1, 25), 1: (3, 1, 3)}


def test_counters_missing_is_not_zero(spark) -> None:
    df = spark.createDataFrame([("a", {"k": 0, "w": 1}), ("b", {"w": 0}), ("c", {"k": 2, "w": 5})], "run string, counters map<string,bigint>")
    out = {(r.run, r.problem) for r in audit.counter_errors(df, ("k",), ("w",)).collect()}
    assert out == {("b", "k missing"), ("b", "no work counted"), ("c", "k not zero")}


def test_quantised_halves_go_away_from_zero(spark) -> None:
    df = spark.createDataFrame([(x,) for x in (2.5, -2.5, 127.0, -127.0, 0.4)], "x double")
    assert [r.q for r in df.select(arrays.quantised(F.col("x"), F.lit(127.0)).alias("q")).collect()] == [3, -3, 127, -127, 0]
    assert spark.range(1).select(arrays.quantised(F.lit(0.0), F.lit(0.0)).alias("q")).first().q == 0


def test_table_sizes() -> None:
    assert arrays.table_sizes(2, 500_000) == [499801, 499819]
    assert arrays.table_sizes(3, 257) == [257, 258, 259]


def test_layers(spark) -> None:
    at = lambda p, n: spark.range(1).select(arrays.layers(F.lit(p), n).alias("x")).first().x
    assert at("aem", 4) == ["A", "E", "M", "A"]
    assert at("A|EM", 3) == ["A", "E", "M"]
    assert at("A|EM", 4) is None


def test_masked_softmax_is_nan(spark) -> None:
    df = spark.createDataFrame([(1, float("-inf")), (1, float("-inf")), (2, 0.0), (2, float("-inf"))], "g int, score double")
    rows = sequence.softmax(df, ["g"]).collect()
    assert all(math.isnan(r.weight) for r in rows if r.g == 1)
    assert sorted(r.weight for r in rows if r.g == 2) == [0.0, 1.0]


def test_recurrence_and_momentum(spark) -> None:
    df = spark.createDataFrame([(1, 1, 0.5, 0.2, 0.3), (1, 0, -1.0, 0.9, 0.3)], "id long, pos long, x double, f double, w double")
    h0 = 0.1 * math.tanh(-1.0)
    h1 = 0.2 * h0 + 0.8 * math.tanh(h0 * 0.3 + 0.5)
    assert [pytest.approx(r.h) for r in sequence.recurrence(df).orderBy("pos").collect()] == [h0, h1]
    steps = spark.createDataFrame([(1, 0, 1.0), (1, 1, -1.0)], "id long, step long, g double")
    m = round(0.5 * 127) / 127
    assert sequence.momentum(steps, 0.5).first().m == pytest.approx(round((0.5 * m - 0.5) * 127) / 127, abs=0.01)


def test_correlation(spark) -> None:
    r = lambda rows: audit.correlation(spark.createDataFrame(rows, "x long, y double"), "x", "y").first().r
    assert r([(1, 2.0), (2, 4.0), (3, 5.0), (None, 9.0), (9, None)]) == pytest.approx(0.9819805)
    assert math.isnan(r([(1, 0.1), (2, 0.1), (5, 0.1)])) and math.isnan(r([(1, 2.0)]))
    assert r([]) is None and r([(1, None)]) is None


def test_first_objects(spark) -> None:
    df = spark.createDataFrame([(1, "x {bad {\"a\": 1} y"), (2, "none"), (3, None)], "id long, value string")
    assert {r.id: r.object for r in sequence.first_objects(df).collect()} == {1: '{"a": 1}', 2: None, 3: None}


def test_packed_files(spark, tmp_path) -> None:
    packed.register(spark)
    lists = spark.createDataFrame([([1, 2, 131071],), ([],), (None,), ([4],)], "tokens array<long>").coalesce(1)
    lists.write.format("packed_tokens").mode("append").save(str(tmp_path / "p"))
    rows = spark.read.format("packed_tokens").load(str(tmp_path / "p")).orderBy("doc_idx").collect()
    assert [r.tokens for r in rows] == [[1, 2, 131071], [4]]
    head = next((tmp_path / "p").glob("*.idx")).read_bytes()
    assert packed.read_header(head) == (2, "uint32")
    with pytest.raises(ValueError, match="not an index"):
        packed.read_header(b"nothing of the kind, at any rate here")


def test_stream_shards_resume(spark, tmp_path) -> None:
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for part in range(2):
        spark.range(part * 25, part * 25 + 25).selectExpr("concat('t', lpad(id, 3, '0')) as text").coalesce(1).write.mode("append").json(folder)
        jobs.shard_sink(jobs.text_stream(spark, folder), out, state, 10, "text").awaitTermination()
    sizes = {r.shard: r["count"] for r in spark.read.parquet(f"{out}/rows").groupBy("shard").count().collect()}
    assert sizes == {k: 10 for k in range(5)}
