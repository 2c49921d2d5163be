"""Order statistics, the best of a row, and chunked recurrences against plain Python."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import audit, scans, selection, sequence


@pytest.mark.parametrize(("bins", "gather"), [(256, 4096), (4, 3), (2, 1)])
def test_order_statistics(spark, monkeypatch, bins: int, gather: int) -> None:
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "GATHER", gather)
    rng, inf = np.random.default_rng(bins), math.inf
    groups = {
        "hot": [*rng.normal(size=150).tolist(), *[0.25] * 60], "wide": [1e308, -1e308, 1e-300, 0.0, -0.0, 5.0, 5.0], "one": [7.0], "ends": [inf, inf, -inf, 1.0, 2.0], "same": [3.0] * 40,
        "endless": [inf, inf, -inf], None: [1.0, 2.0, 4.0, 4.0],
    }
    rows = [(k, v, 1, "x") for k, vs in groups.items() for v in [*vs, None, math.nan]] + [("none", None, 1, "x")]
    df = spark.createDataFrame(rows, "k string, v double, n int, name string").repartition(4)
    got = {r.k: tuple(r)[1:] for r in selection.order_statistics(df, ["k"], "v", {"low": "(n + 1) div 2", "least": "1", "most": "n", "third": "3"}).collect()}
    want = {k: (len(v), sorted(v)[(len(v) + 1) // 2 - 1], min(v), max(v), sorted(v)[2] if len(v) > 2 else None) for k, v in groups.items()}
    assert got == want
    assert selection.order_statistics(df.filter("k = 'none'"), ["k"], "v", {"a": "1"}).count() == 0


def test_bench_stats_and_lower_median(spark) -> None:
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=5000).round(3).tolist(), "b": [4.0], "c": [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "name string, ms double")
    got = {r.name: r for r in audit.bench_stats(df).collect()}
    for k, v in data.items():
        s = sorted(v)
        assert (got[k].n, got[k].p50, got[k].p99) == (len(v), s[len(v) // 2], s[int(len(v) * 0.99)])
        assert (got[k].median, got[k].stdev) == (pytest.approx(statistics.median(v), abs=1e-6), pytest.approx(statistics.pstdev(v), abs=1e-6))
    out = audit.bench_stats(df)._jdf.queryExecution().toString()
    assert "Window" not in out and "percentile" not in out
    assert {r.name: r.lower_median for r in audit.lower_median(df, "name", "ms").collect()} == {k: statistics.median_low(v) for k, v in data.items()}


def test_best_of_a_row_in_bounds(spark) -> None:
    scores = spark.createDataFrame([(r, p, float((p * 7 + r) % 5)) for r in range(3) for p in range(40)], "row int, pos int, score double").repartition(4)
    bounds = spark.createDataFrame([(0, 5, 20), (1, 38, 60), (2, 9, 9)], "row int, start int, end int")
    out = sequence.top_k(scores, 4, bounds)
    want = {(r, p, k) for r, a, b in ((0, 5, 20), (1, 38, 40)) for k, (_, p) in enumerate(sorted((-((p * 7 + r) % 5), p) for p in range(a, b))[:4], 1)}
    assert {(r.row, r.pos, r.rank) for r in out.collect()} == want
    selected = sequence.selected_top_k(scores.unionByName(spark.createDataFrame([(0, 6, None), (0, 7, math.nan)], scores.schema)), 4, bounds)
    assert {(r.row, r.pos, r.rank) for r in selected.collect()} == want
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()  # k rows of a row leave a task


@pytest.mark.parametrize(("forget", "width", "block"), [(0.5, 16, 128), (0.999, 7, 3), (0.9, 1000, 128)])
def test_chunks_equal_the_sequential_form(spark, monkeypatch, forget: float, width: int, block: int) -> None:
    monkeypatch.setattr(scans, "BLOCK", block)
    rng = np.random.default_rng(width)
    rows = [(i, p, float(rng.normal()), min(forget + 0.01 * float(rng.random()), 1.0), 0.7) for i, n in ((1, 900), (None, 40), (3, 1)) for p in range(n) if p % 11 or not i]
    df = spark.createDataFrame(rows, "id long, pos long, x double, f double, w double").repartition(4)
    want: dict = {}
    h = dict.fromkeys((1, None, 3), 0.0)
    for i, p, x, f, w in rows:
        h[i] = f * h[i] + (1 - f) * math.tanh(h[i] * w + x)
        want[i, p // width] = h[i]
    got = {(r.id, r.chunk): r.h for r in sequence.chunked_recurrence(df, width).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, abs=1e-11) for k, v in want.items())
    assert sequence.chunked_recurrence(df.filter("pos < 0"), width).count() == 0
