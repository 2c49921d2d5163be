"""LM scoring over several chunks and shards, against scores of one chunk."""

from __future__ import annotations

import random

import pytest

from corpusmill.llm import lm_score


def test_chunks_and_shards_change_nothing(spark, monkeypatch) -> None:
    rng = random.Random(11)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(0, 90))) for _ in range(120)]
    texts += [texts[3], texts[3] + " tail", "hot " * 500, "a hot b " * 200, None, "", "x" * 70_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = lambda: sorted(tuple(r) for r in lm_score.scores(docs).collect())
    whole = rows()
    # Sizes travel with the tasks' code only through the module, so local workers are forked after the change.
    monkeypatch.setattr(lm_score, "SHARD_KEYS", 300)
    small = rows()
    assert [r[:5] for r in small] == [r[:5] for r in whole]
    for a, b in zip(small, whole, strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_parts_of_one_chunk_only_are_not_sent() -> None:
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([False, True]), pa.array(["a b c", "a b d"])], ["doc_id", "held_out", "text"])
    packed = next(lm_score._packed(iter([batch])))
    chunk = lm_score.Chunk(packed.to_pylist()[0])
    chunk.count_words(), chunk.count_pairs(), chunk.count_triples()
    assert len(chunk.asked(0, [])[0]) == 6  # a, b, c, d, begin and end
    none = [np.zeros(6, np.int64)]
    assert not len(chunk.asked(1, none)[0])
    assert (chunk.whole(1, [none[0], np.zeros(0, np.int64)]) == chunk.n2).all()
    every = [2 * chunk.n1 + 1]
    assert len(chunk.asked(1, every)[0]) == len(chunk.n2)
