"""The counting quotient filter against a counter, and exact deduplication against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup, quotient_filter


@pytest.mark.parametrize(("n", "width", "alike"), [(0, 20, 1), (1, 1, 1), (1, 63, 1), (2000, 54, 3), (3000, 12, 50), (500, 9, 400), (4000, 63, 1)])
def test_filters_merge_without_loss(n: int, width: int, alike: int) -> None:
    rng = np.random.default_rng(n + width)
    values = rng.integers(0, 1 << width, max(1, n // alike), dtype=np.uint64)[rng.integers(0, max(1, n // alike), n)] if n else np.zeros(0, np.uint64)
    values[: n // 5] = values[:1]  # a hot one
    filters = [quotient_filter.encode(*quotient_filter.counted(part), width) for part in np.array_split(values, 3)]
    got, counts = quotient_filter.decode(quotient_filter.encode(*quotient_filter.merged([quotient_filter.decode(f) for f in filters]), width))
    assert got.tolist() == sorted(got.tolist())
    assert dict(zip(got.tolist(), counts.tolist(), strict=True)) == Counter(values.tolist())


def test_counts_of_many_digits() -> None:
    values, counts = np.array([1, 2, 7], np.uint64), np.array([10**12, 1, 257], np.uint64)
    assert [x.tolist() for x in quotient_filter.decode(quotient_filter.encode(values, counts, 5))] == [values.tolist(), counts.tolist()]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    texts = [f"text {k % 70} " * (k % 9) for k in range(300)] + ["hot"] * 150 + [None, "", " ", "Hot", "hot ", "é", "é", "x" * 3_000_000, "x" * 3_000_000]
    out = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    return [*out, out[0], out[310], (None, "hot"), (None, "only here"), (None, "only here")]


@pytest.mark.parametrize(("held", "bound"), [(1 << 21, 500_000), (50, 0)])
def test_classes(spark, rows, monkeypatch, held: int, bound: int) -> None:
    monkeypatch.setattr(exact_dedup, "HELD", held)
    monkeypatch.setattr("corpusmill.llm.tables.BROADCAST_ROWS", bound)
    docs = spark.createDataFrame([(i, t, 1, 2, "s", 4, 5) for i, t in rows], "doc_id long, text string, fp int, row int, stays string, filter int, range int").repartition(7)
    got = sorted(tuple(repr(x) for x in r) for r in exact_dedup.classes(docs).collect())
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(-1 if i is None else i)
    want = []
    for t, ids in groups.items():
        keep, sha = max(ids), hashlib.sha256(t.encode()).hexdigest()
        for k, i in enumerate(sorted(ids)):
            want.append(tuple(repr(x) for x in (None if i < 0 else i, None if keep < 0 else keep, len(ids), k == len(ids) - 1, sha)))
    assert got == sorted(want)


def test_one_fingerprint_of_two_texts(spark, monkeypatch) -> None:
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda c: F.length(c).cast("long"))
    docs = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa"), (4, "c")], "doc_id int, text string")
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.classes(docs).collect()) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True)]


def test_no_rows(spark) -> None:
    assert exact_dedup.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
