"""Embedding whitening against exact integers and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from corpusmill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n string, component int, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "s", 3, 4) for i, v in rows], SCHEMA).repartition(5)


def solved(spark, rows, most=16):
    return whitening.whitened(whitening.steps(frame(spark, rows)), most).collect()


@pytest.mark.parametrize("dim", [1, 2, 3, 20, 64])
def test_symmetric_qr(dim: int) -> None:
    rng = np.random.default_rng(dim)
    basis = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    for a in (basis @ np.diag(rng.normal(size=dim)) @ basis.T, np.eye(dim), np.zeros((dim, dim)), basis @ np.diag(np.r_[[5.0] * (dim - dim // 2), [0.0] * (dim // 2)]) @ basis.T):
        values, vectors = whitening.symmetric_qr(a)
        assert np.abs(values - np.sort(np.linalg.eigvalsh(a))[::-1]).max() < 1e-13 * (1 + dim)
        assert np.abs(vectors @ vectors.T - np.eye(dim)).max() < 1e-13 * (1 + dim)
        assert np.abs(vectors @ a @ vectors.T - np.diag(values)).max() < 1e-13 * (1 + dim)


def test_merged_updates_equal_one_pass() -> None:
    rows = np.random.default_rng(1).normal(size=(500, 6)) * 5 + 1e6
    whole = whitening.Moments(6)
    for cut in np.split(rows, [1, 7, 300]):
        part = whitening.Moments(6)
        for row in cut:
            part.add(row)
        whole.merge(part.n, part.sums, part.mean, part.moments)
    assert np.allclose(whole.moments / whole.n, np.cov(rows.T, bias=True), rtol=1e-9)


def test_whitened_against_exact_integers(spark, monkeypatch) -> None:
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(20, 20)) / 4
    good = [(k, [float(np.float32(c)) for c in rng.normal(size=20) @ mix]) for k in range(300)]
    rows = [*good, *[(1000 + k, good[3][1]) for k in range(150)], (None, good[4][1]), (5, good[5][1])]
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [math.nan] + [0.0] * 19), (904, [math.inf] * 20), (905, [0.0] * 19 + [-math.inf])]
    got = solved(spark, rows + bad)
    x = {k: [math.floor(64 * c) + 1_000_000 for c in v] for k, (_, v) in enumerate(rows)}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(v[j] for v in fit) for j in range(20)]
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    want = sorted(("" if i is None else str(i), sum((n * c - s) ** 2 for c, s in zip(x[k], sums, strict=True))) for k, (i, _) in enumerate(rows) for _ in range(16))
    assert sorted(("" if r.vec_id is None else str(r.vec_id), r.deviation) for r in got) == want
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    at = {v: k for k, v in enumerate(fit)}
    projected = centred @ vectors[:, :16] / np.sqrt(values[:16])
    own = {r.vec_id: {} for r in got}
    for r in got:
        own[r.vec_id][r.component] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
    for c in range(16):
        pairs = [(own[i][c + 1], projected[at[tuple(x[k])], c]) for k, (i, _) in enumerate(rows) if i is not None]
        sign = np.sign(pairs[0][0] * pairs[0][1])
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-8


def test_no_rows_no_spread_and_few_dimensions(spark) -> None:
    assert solved(spark, []) == [] and solved(spark, [(1, None)]) == []
    assert solved(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []
    got = solved(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])])
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got) == [(k, 1, 2, 64 * 64, 1.0, 1.0) for k in (1, 2, 3)]
    with pytest.raises(Exception, match="unlike lengths"):
        solved(spark, [(1, [0.0, 1.0]), (2, [1.0])])


def test_deviation_beyond_64_bits_is_null(spark) -> None:
    got = solved(spark, [(1, [0.0]), (2, [3e8]), (3, [0.0])])
    assert {r.vec_id: r.deviation for r in got} == {1: None, 2: None, 3: None} and {abs(round(r.whitened, 9)) for r in got} == {1.0}
