"""Blocked scans against plain loops, with hot keys over several ranges and blocks."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import audit, history, scans


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng = np.random.default_rng(8)
    keys = ["hot"] * 900 + ["b"] * 40 + [None] * 25 + ["c"]
    return [(k, int(i), None if rng.random() < 0.3 else round(float(rng.normal()), 3), int(rng.integers(-9, 10))) for k, i in zip(keys, rng.permutation(len(keys)), strict=True)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, i long, v double, c long").repartition(3)


def expected(rows, step, start):
    state, out = defaultdict(lambda: start), {}
    for k, i, v, c in sorted(rows, key=lambda r: r[1]):
        state[k] = step(state[k], v, c)
        out[(k, i)] = state[k]
    return out


@pytest.mark.parametrize("block", [1, 7, 512])
def test_scans(frame, rows, monkeypatch, block: int) -> None:
    monkeypatch.setattr(scans, "BLOCK", block)
    got = lambda df: {(r.k, r.i): r.out for r in df.collect()}
    assert got(scans.last_value(frame, ["k"], ["i"], F.col("v"), "out")) == expected(rows, lambda x, v, c: x if v is None else v, None)
    assert got(scans.clamped_sum(frame, ["k"], ["i"], F.col("c"), "out")) == expected(rows, lambda x, v, c: max(x + c, 0), 0)
    assert got(scans.numbered(frame, ["k"], ["i"], "out")) == expected(rows, lambda x, v, c: x + 1, 0)
    mean = expected(rows, lambda x, v, c: x if v is None else v if x is None else 0.1 * v + 0.9 * x, None)
    own = got(scans.running_mean(frame, ["k"], ["i"], F.col("v"), 0.1, "out"))
    assert own.keys() == mean.keys() and all(own[k] == (None if m is None else pytest.approx(m, abs=1e-12)) for k, m in mean.items())


def test_value_before_the_row_and_no_rows(frame, rows) -> None:
    got = {(r.k, r.i): r.c_ for r in scans.last_value(frame, ["k"], ["i"], F.col("c"), "c_", before=True).collect()}
    last, want = {}, {}
    for k, i, _, c in sorted(rows, key=lambda r: r[1]):
        want[(k, i)] = last.get(k)
        last[k] = c
    assert got == want
    assert scans.numbered(frame.filter("i < 0"), ["k"], ["i"], "n").collect() == []


def test_no_task_is_bound_to_a_key(spark) -> None:
    own = scans.blocks(spark.range(20_000).selectExpr("'one' as k", "id"), ["k"], ["id"], F.struct(F.lit(1).alias("n")))
    ranges = [r[0] for r in own.groupBy("_range").agg(F.sum(F.size("_items"))).select("sum(size(_items))").collect()]
    assert len(ranges) == 4 and max(ranges) < 8000


def test_replay_of_one_device_by_address(spark) -> None:
    rng = np.random.default_rng(2)
    events = [("d", i, ["alloc", "free_completed", "free_requested"][int(rng.integers(0, 3))], int(rng.integers(1, 50)), int(rng.integers(0, 6))) for i in range(3000)]
    live, peak, at, last = 0, 0, -1, {}
    for _, i, action, size, addr in events:
        if action == "free_requested":
            continue
        if action == "alloc":
            live += size
            if live > peak:
                peak, at = live, i
        else:
            was = last.get(addr)
            live = max(live - (was[1] if addr and was and was[0] == "alloc" else size), 0)
        last[addr] = (action, size)
    frame = spark.createDataFrame(events, "device string, idx long, action string, size long, addr long").repartition(4)
    assert tuple(audit.replay(frame).first()) == ("d", peak, at, live)
    assert tuple(audit.replay(frame.withColumnRenamed("idx", "when"), ["when"]).first()) == ("d", peak, at + 1, live)


def test_smoothing_has_no_python_worker(spark) -> None:
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 2, None), (1, 3, float("nan")), (1, 4, 4.0), (2, 1, None)], "port long, ord long, loss double")
    out = history.smoothed(rows, 0.5)
    assert [r.ema for r in out.orderBy("port", "ord").collect()] == [2.0, None, None, 3.0, None]
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_replay_makes_no_lists_of_rows(spark, monkeypatch) -> None:
    made = []
    monkeypatch.setattr(scans, "blocks", lambda *a, **k: made.append(a))
    events = spark.range(400).selectExpr("id % 2 as device", "id as idx", "if(id % 3 = 0, 'free_completed', 'alloc') as action", "id % 7 as size", "id % 5 as addr")
    assert audit.replay(events.repartition(3)).count() == 2 and not made
