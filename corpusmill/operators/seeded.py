"""The seeded shuffle of one random stream over all shards: the order that Python's ``random.Random(seed).shuffle`` gives.

Shards are shuffled one after the other from one Mersenne Twister, so where a shard begins in the stream hangs on all draws before
it.  One ordered task walks the stream alone (a row per shard, no documents pass through it) and stores the generator's state at
the start of each shard; the shards are then shuffled side by side from their states.  A shard has a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.tables import scratch_path

STATE_WORDS = 624


def picks(words: np.ndarray, n: int) -> tuple[np.ndarray, int] | None:
    """The places drawn for the last of n items, the last but one and so on to the second, and the number of words used; None
    if the words do not reach.

    A draw below b takes the top bits of a word, as many as b has, and throws away what is not below b.  Which words pass hangs
    on how many passed before; all words of the same number of bits are settled together, from a guess that is put right until
    nothing moves.  Each round settles at least one word more, so what is left is the sequential result.
    """
    out, used, top = [], 0, n
    while top > 1:
        bits = top.bit_length()
        want = top - max(1 << (bits - 1), 2) + 1
        value = (words[used : used + 3 * want + 64] >> np.uint32(32 - bits)).astype(np.int64)
        passed = value < top * np.exp(-np.arange(len(value)) / (1 << bits))
        while True:
            settled = value < top - (np.cumsum(passed) - passed)
            if np.array_equal(settled, passed):
                break
            passed = settled
        at = np.flatnonzero(passed)[:want]
        if len(at) < want:
            return None
        out.append(value[at])
        used, top = used + int(at[-1]) + 1, top - want
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), used


def _generator(state: bytes) -> np.random.MT19937:
    key = np.frombuffer(state, np.uint32)
    generator = np.random.MT19937()
    generator.state = {"bit_generator": "MT19937", "state": {"key": key[:STATE_WORDS], "pos": int(key[STATE_WORDS])}}
    return generator


def _state(generator: np.random.MT19937) -> bytes:
    state = generator.state["state"]
    return np.append(state["key"], state["pos"]).astype(np.uint32).tobytes()


def first_state(seed: int) -> bytes:
    """The state that Python's generator has after it was seeded with a whole number."""
    import random

    return np.array(random.Random(seed).getstate()[1], np.uint32).tobytes()


def drawn(state: bytes, n: int) -> tuple[np.ndarray, bytes]:
    """The places drawn for n items from ``state``, and the state after them."""
    spare = n + n // 2 + 64
    while (found := picks(_generator(state).random_raw(spare).astype(np.uint32), n)) is None:
        spare *= 2
    after = _generator(state)
    after.random_raw(found[1])
    return found[0], _state(after)


def _states(seed: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = first_state(seed)
        for batch in batches:
            states = []
            for n in batch.column("n").to_pylist():
                states.append(state)
                state = drawn(state, n)[1]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("n"), pa.array(states, pa.binary())], ["shard", "n", "state"])

    return walk


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, n, state in zip(*(batch.column(c).to_pylist() for c in ("shard", "n", "state")), strict=True):
            order = list(range(n))
            for i, j in zip(range(n - 1, 0, -1), drawn(state, n)[0].tolist(), strict=True):
                order[i], order[j] = order[j], order[i]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([order], pa.list_(pa.int32()))], ["shard", "order"])


def shard_orders(sizes: DataFrame, seed: int) -> DataFrame:
    """shard, order: for each shard of ``sizes`` (shard, n), taken by rising number, the places from 0 that its rows came from."""
    spark, path = sizes.sparkSession, scratch_path(sizes.sparkSession, "shard-states")
    ordered = sizes.select(F.col("shard").cast("long"), F.col("n").cast("long")).repartition(1).sortWithinPartitions("shard")
    ordered.mapInArrow(_states(seed), "shard long, n long, state binary").write.parquet(path)
    states = spark.read.schema("shard long, n long, state binary").parquet(path)
    return states.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").mapInArrow(_orders, "shard long, order array<int>")


def shuffled(plan: DataFrame, seed: int) -> DataFrame:
    """doc_id, shard, part, place (from 1) of ``plan`` (doc_id, shard, part; ``operators.corpus.shard_plan``): the training rows of
    each shard, in doc_id order, are shuffled from one stream over all shards; validation keeps its order.

    Equal doc_ids are shuffled as different rows; an empty plan gives an empty result.
    """
    path = scratch_path(plan.sparkSession, "shard-ids")
    lists = plan.groupBy("shard", "part").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))  # at most a file's rows
    lists.write.parquet(path)
    stored = plan.sparkSession.read.schema(lists.schema).parquet(path)
    orders = shard_orders(stored.filter("part = 'train'").select("shard", F.size("ids").alias("n")), seed)
    both = stored.join(orders.select(F.col("shard").alias("_shard"), "order"), (F.col("shard") == F.col("_shard")) & (F.col("part") == "train"), "left")
    ids = F.coalesce(F.transform("order", lambda p: F.get("ids", p)), F.col("ids"))
    return both.select("shard", "part", F.posexplode(ids).alias("_at", "doc_id")).select("doc_id", "shard", "part", (F.col("_at") + 1).alias("place"))
