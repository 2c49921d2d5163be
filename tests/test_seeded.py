"""The seeded shuffle against Python's own, shard after shard from one generator."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import corpus, seeded


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 31, 32, 33, 624, 1000, 32767, 32768, 50000])
def test_draws_of_one_list(n: int) -> None:
    rng, state = random.Random(42), seeded.first_state(42)
    for _ in range(3):
        places, state = seeded.drawn(state, n)
        mine = list(range(n))
        for i, j in zip(range(n - 1, 0, -1), places.tolist(), strict=True):
            mine[i], mine[j] = mine[j], mine[i]
        theirs = list(range(n))
        rng.shuffle(theirs)
        assert mine == theirs
        assert np.frombuffer(state, np.uint32).tolist() == list(rng.getstate()[1])


def test_too_few_words() -> None:
    assert seeded.picks(np.zeros(0, np.uint32), 5) is None
    assert seeded.picks(np.full(100, 2**32 - 1, np.uint32), 5) is None
    places, used = seeded.picks(np.zeros(10, np.uint32), 5)
    assert places.tolist() == [0] * 4 and used == 4


@pytest.mark.parametrize(("total", "per_file"), [(0, 10), (1, 10), (9, 10), (10, 10), (11, 10), (997, 100), (1000, 100), (3001, 1000)])
def test_shards_follow_one_stream(spark, total: int, per_file: int) -> None:
    plan = corpus.shard_plan(spark.range(total).select((F.col("id") * 3).alias("doc_id")).repartition(5), per_file)
    got = {(r.shard, r.part, r.place): r.doc_id for r in seeded.shuffled(plan, 7).collect()}
    rng, want, ids = random.Random(7), {}, [3 * i for i in range(total)]
    full = total - total % per_file
    rest, n_val = ids[full:], max(1, int(total * 0.01))
    train, val = (rest[:-n_val], rest[-n_val:]) if len(rest) > n_val else (rest, [])
    for shard, rows in enumerate([ids[i : i + per_file] for i in range(0, full, per_file)] + ([train] if train else [])):
        rows = list(rows)
        rng.shuffle(rows)
        want |= {(shard, "train", i + 1): v for i, v in enumerate(rows)}
    want |= {(full // per_file, "val", i + 1): v for i, v in enumerate(val)}
    assert got == want
