"""Texts beyond the chunks that operators read, and the pipeline over nulls, repeats, clashing columns and no rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import chaining, decontaminate, kneser_ney, ngram_join, quality_rules, suffix_dedup

ITEM = "A train leaves the northern station before noon and reaches the southern harbour after dark so how long was it on the way"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[str]:
    """Two texts of 1.5 MB whose last parts are alike, one that ends with an item, and a near copy of the first."""
    rng = random.Random(3)
    first, shared = prose(rng, 220_000), prose(rng, 60)
    other = prose(rng, 220_000)
    near = first.split(" ")
    near[100:200] = ["changed"] * 100
    return [first + " " + shared, other + " " + shared, prose(rng, 50) + " " + prose(rng, 200_000) + " " + ITEM, " ".join(near)]


@pytest.fixture(scope="module")
def long_docs(spark, texts):
    assert min(map(len, texts)) > 1_200_000
    return spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(4)


def test_long_texts_of_exact_operators(long_docs, texts) -> None:
    links = {r.doc_id: (r.component_id, r.n_shingles) for r in ngram_join.components(long_docs).collect()}
    words = [t.split(" ") for t in texts]
    assert {i: c for i, (c, _) in links.items()} == {0: 0, 1: 1, 2: 2, 3: 0}
    assert all(links[i][1] == len({tuple(w[k : k + 5]) for k in range(len(w) - 4)}) for i, w in enumerate(words))
    counts = {r.doc_id: r.word_chars for r in quality_rules.with_counts(long_docs).collect()}
    assert counts == {i: len(re.sub(" ", "", t)) for i, t in enumerate(texts)}
    gone = {r.doc_id: r.n_removed for r in suffix_dedup.removed_spans(long_docs.filter("doc_id < 3")).collect()}
    shared = len(texts[0]) - len(" ".join(words[0][:-60]))
    assert gone == {0: shared, 1: shared, 2: 0}


def test_long_texts_of_searches(spark, long_docs) -> None:
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.hits(long_docs, bench).collect()] == [(2, 7)]
    found = {r.doc_id: r.n_covered for r in chaining.repeated(long_docs.filter("doc_id < 3")).collect()}
    assert set(found) == {0, 1} and all(60 <= n <= 64 for n in found.values())


def test_long_texts_of_the_classifier(spark, long_docs) -> None:
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(long_docs, labels).collect()
    assert len(rows) == 4 and all(r.perplexity > 0 for r in rows)


CLASH = ("key", "seed", "window", "pos", "n", "item_id", "component_id", "row", "kept", "d")


@pytest.mark.parametrize("some", [True, False])
def test_pipeline_over_odd_rows(spark, sf, some: bool) -> None:
    rng = random.Random(11)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40).drop("n_chars")
    odd = [(None, prose(rng, 80), "en", "s"), (9001, None, "en", None), (9002, "", None, "s"), (9003, " \n\t", None, None), (9004, prose(rng, 90), None, None)]
    odd += [odd[-1], odd[-1], (9005, odd[0][1], "en", "s")]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("n_chars", F.length("text").cast(spark.read.parquet(f"{sf}/documents.parquet").schema["n_chars"].dataType))
    rows = rows.withColumns({c: F.lit(k) for k, c in enumerate(CLASH)}).filter(F.lit(some)).repartition(3)
    columns, kept = rows.columns, rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert sorted(kept.columns) == sorted(columns), name
        kept = corpus_pipeline.stored(kept, f"edges-{name}")
    out = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    got = [r.doc_id for r in out.collect()]
    assert out.count() == kept.count() and (len(got) > 5) == some
    if some:
        assert not {9001, 9002, 9003} & set(got)  # no words: rejected
        assert got.count(9004) == 1 and got.count(9005) + got.count(None) == 1
