"""Hard-negative mining against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from corpusmill.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row int, w string, anchor int, top int, windows int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "s", 2, 3, 4, "t") for i, v, c in rows], SCHEMA).repartition(5)


def brute(rows, scale, every, low=50, high=95):
    own = [(i, [math.floor(scale * float(np.float32(c))) for c in v], c) for i, v, c in rows if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, x, c in own:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j, d) for j, y, d in own if j != i)
        for s, j, _ in [r for r in scored if r[2] == c][:5]:
            fits = [(-t, k) for t, k, d in scored if d != c and low * -s <= 100 * -t <= high * -s]
            out += [(i, j, rank, k, -s, t) for rank, (t, k) in enumerate(fits[:3], 1)]
    return sorted(out)


def mined(spark, rows, scale, every):
    return sorted(tuple(r) for r in hard_negatives.mined(hard_negatives.whole_steps(frame(spark, rows), scale), f"vec_id % {every} = 0").collect())


@pytest.mark.parametrize(("scale", "digit", "gather"), [(256, 8, 64), (4, 3, 4), (20_000, 5, 8), (30_000_000, 8, 64)])
def test_against_brute_force(spark, monkeypatch, scale: int, digit: int, gather: int) -> None:
    """Scores with and without many ties, of a size for each kind of number; a hot vector, repeated rows and rows that take no part."""
    monkeypatch.setattr(hard_negatives, "DIGIT", digit)
    monkeypatch.setattr(hard_negatives, "GATHER", gather)
    rng = np.random.default_rng(digit)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(240, 6)).astype(np.float32)]
    rows = [(int(i), v, int(rng.integers(0, 3))) for i, v in zip(rng.permutation(240) * 5 - 300, vectors, strict=True)]
    rows += [(2000 + k, vectors[0], k % 2) for k in range(120)] + [(2001, vectors[0], 1)] * 3 + [rows[7], (15, vectors[9], 2)]
    bad = [(None, vectors[1], 1), (5001, None, 1), (5002, [], 1), (5003, [None] * 6, 1), (5004, [math.nan] * 6, 1), (5005, [math.inf] * 6, 0), (5006, vectors[2], None)]
    got = mined(spark, rows + bad, scale, 25)
    assert got == brute(rows, scale, 25) and len(got) > 20


def test_equal_scores_of_all_rows(spark, monkeypatch) -> None:
    monkeypatch.setattr(hard_negatives, "GATHER", 3)
    rows = [(k * 3 - 500, [1.0, 0.0], k % 2) for k in range(300)] + [(4000, [0.9, 0.0], 0)]
    assert mined(spark, rows, 100, 50) == brute(rows, 100, 50)


def test_nothing_to_mine(spark) -> None:
    assert mined(spark, [], 256, 5) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 1)], 256, 5) == []
    assert mined(spark, [(5, [1.0], 1), (6, [-1.0], 1), (7, [1.0], 2)], 256, 5) == []  # a positive below 0
    with pytest.raises(ValueError, match="unlike lengths"):
        mined(spark, [(5, [1.0], 1), (6, [1.0, 2.0], 1)], 256, 5)
    with pytest.raises(ValueError, match="55 bits"):
        mined(spark, [(5, [1.0] * 9, 1)], 1 << 28, 5)
