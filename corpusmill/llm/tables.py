"""Reading driver tables and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where that is unset, a new temporary folder of a local session, and an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    made = tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used."""
    return os.path.join(shared_dir(spark), "tables", f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: lineage is cut and lost executors cost nothing.

    The written schema is passed on, so no job infers it, and an empty result stays readable.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``stored``, as a table in ``buckets`` by ``key``: joins on the key leave it where it is."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    name = os.path.basename(path).replace("-", "_")
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as keep it apart from the columns of ``df`` (Spark's names have no case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows (each under about 100 bytes) up to which a counted table is broadcast; beyond it Spark shuffles.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count proves it small; give it a stored table, for it is read twice."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the Python worker, which Spark keeps for later tasks, gives its free memory back."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def grouped_rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the runs of equal ``key`` in a partition sorted by it; only the run at hand is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(key).to_numpy()
        if not len(values):
            continue
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        starts = [0, *cuts.tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)]).combine_chunks()
            held = []
        held.append(batch.slice(starts[-1]))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
