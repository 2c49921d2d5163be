"""Streaming jobs: shards from a growing folder, deduplicated history, running totals and live log status.

Every job processes what is there and stops (``availableNow``), or goes on with another trigger; checkpoints make it resume.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from corpusmill.operators.ordinals import row_numbers
from corpusmill.sources import tailing

TEXT, STATE = "text string", "port long, ord long, step long, seen long"


def text_stream(spark: SparkSession, folder: str, schema: str = TEXT, idle: float | None = None) -> DataFrame:
    """Documents of the JSON lines files in a folder, which may grow and need not be there yet; blank lines and those without a
    text are dropped.  A line that is half written waits for its end, or for ``idle`` seconds in which its file does not grow."""
    tailing.register(spark)
    source = spark.readStream.format("line_tail").option("path", folder)
    lines = (source if idle is None else source.option("idle", idle)).load()
    return lines.select(F.from_json("value", schema).alias("row")).select("row.*").filter("text is not null")


def run_until_idle(query: StreamingQuery, idle: float, poll: float = 0.2) -> None:
    """Lets a query run until no rows have come for ``idle`` seconds (its first batch has all the time it takes), then ends it."""
    since, last = time.monotonic(), None
    while query.isActive:
        progress, status = query.lastProgress, query.status
        at = progress and progress["numInputRows"] and progress["batchId"]
        busy = status["message"].startswith("Initializing") or (status["isTriggerActive"] and status["isDataAvailable"])
        if busy or at != last:
            since, last = time.monotonic(), at
        elif time.monotonic() - since > idle:
            query.stop()
        time.sleep(poll)
    if query.exception():
        raise query.exception()  # type: ignore[misc]


def shard_sink(rows: DataFrame, out: str, checkpoint: str, rows_per_file: int, order: str):
    """Starts a query that cuts the stream, in arrival order, into shards of ``rows_per_file`` rows.

    The count of the batches before decides where a batch goes on; inside it rows are numbered by sorted ranges, so a batch of
    any size is spread over all tasks.  A batch is written under its own number, so that one that is repeated replaces what it
    wrote: ``out/rows/shard=../batch=..`` and ``out/counts/batch=..``.
    """

    def cut(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema("n long, batch long").parquet(f"{out}/counts").filter(F.col("batch") < number).agg(F.sum("n")).first()[0] if number else 0
        placed = row_numbers(batch, [order], "_place")
        shard = F.floor((F.col("_place") + F.lit(before or 0)) / rows_per_file)
        mode = {"partitionOverwriteMode": "dynamic"}
        placed.withColumns({"shard": shard, "batch": F.lit(number)}).drop("_place").write.mode("overwrite").options(**mode).partitionBy("shard", "batch").parquet(f"{out}/rows")
        placed.agg(F.count("*").alias("n")).withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").options(**mode).partitionBy("batch").parquet(f"{out}/counts")

    return rows.writeStream.foreachBatch(cut).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed_sink(snapshots: DataFrame, out: str, checkpoint: str, live: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Starts a query that keeps port, ord, step of the snapshots whose step is not that of the port's last one.

    Within a batch snapshots follow each other by ord, batches as they come: a port's last snapshot is that of greatest ord in the
    last batch that had the port.  The state is one row for each port, ``out/state/slot=0`` and ``1`` by turns, so a batch reads
    what the one before wrote, however many came before, and a repeated one reads and replaces the same.  A port that no batch
    of the last ``live`` had is forgotten and counts as new when it comes back (None: never).  Rows go to ``out/rows/batch=..``.
    Each batch is one sort by port and ord, which Spark spills, however many rows a port has.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark, columns = batch.sparkSession, ["port", "ord", "step"]
        known = spark.createDataFrame([], STATE)
        if number:
            known = spark.read.schema(STATE).parquet(f"{out}/state/slot={(number - 1) % 2}")
        rows = batch.select(*columns, F.lit(True).alias("_own")).unionByName(known.select(*columns, F.lit(False).alias("_own")))
        order = Window.partitionBy("port").orderBy("_own", "ord", "step")
        rows = rows.withColumns({"_first": F.row_number().over(order) == 1, "_before": F.lag("step").over(order)})
        kept = rows.filter(F.col("_own") & (F.col("_first") | ~F.col("step").eqNullSafe(F.col("_before")))).select(*columns)
        kept.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        ends = batch.groupBy("port").agg(F.max(F.struct("ord", "step")).alias("m")).select("port", "m.ord", "m.step", F.lit(number).cast("long").alias("seen"))
        both = known.unionByName(ends).groupBy("port").agg(F.max(F.struct("seen", "ord", "step")).alias("m")).select("port", "m.ord", "m.step", "m.seen")
        still = both if live is None else both.filter(F.col("seen") > number - live)
        still.write.mode("overwrite").parquet(f"{out}/state/slot={number % 2}")

    return snapshots.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def totals_stream(rows: DataFrame, key: str) -> DataFrame:
    """Rows and characters so far per key."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


class RunStatus(StatefulProcessor):
    """The status of a run from its log lines: oom, nan or running, and timeout by a timer when it is past its deadline.

    The state holds the place of the iteration seen last, the iteration and the status, so the lines of a batch may come in any
    order and in any number of frames.  The timer is set by the first line and, if the deadline is one of silence, anew by every
    batch with lines.  When it fires, a run that is still running is ``timeout`` and its state goes; others keep what they are.
    """

    def __init__(self, deadline_ms: int | None, of_silence: bool = True) -> None:
        self.deadline_ms, self.of_silence = deadline_ms, of_silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "place long, iteration int, status string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        fresh = not self.state.exists()
        place, iteration, status = (-1, 0, "running") if fresh else self.state.get()
        for frame in rows:
            place, iteration, status = classified((place, iteration, status), frame)
        self.state.update((place, iteration, status))
        if self.deadline_ms and (fresh or self.of_silence):
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.deadline_ms)
        yield pd.DataFrame({"run": [key[0]], "status": [status], "iteration": pd.array([iteration], dtype="int32")})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        _, iteration, status = self.state.get()
        self.state.clear()
        yield pd.DataFrame({"run": [key[0]], "status": ["timeout" if status == "running" else status], "iteration": pd.array([iteration], dtype="int32")})

    def close(self) -> None:
        """Nothing is held open."""


def classified(state: tuple[int, int, str], frame: pd.DataFrame) -> tuple[int, int, str]:
    """place, iteration and status after more lines (line_no, value), in any order."""
    place, iteration, status = state
    found = frame["value"].str.extract(r"iteration\s+(\d+)/")[0].dropna()
    if len(found):
        last = frame["line_no"][found.index].idxmax()
        place, iteration = max((place, iteration), (int(frame["line_no"][last]), int(found[last])))
    if frame["value"].str.contains("OutOfMemoryError|CUDA out of memory").any():
        status = "oom"
    elif status == "running" and frame["value"].str.contains(r"grad norm: (?:nan|inf)").any():
        status = "nan"
    return place, iteration, status


def status_stream(lines: DataFrame, deadline_ms: int | None = 20 * 60 * 1000, of_silence: bool = True) -> DataFrame:
    """run, status, iteration after each batch of log lines (run, line_no, value), and when a run's deadline passes: in silence
    since its last lines, or in all since its first.  Without a deadline (a run that only catches up and stops) nothing times out.

    Timers need the state store on disk, which is set for the session.
    """
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return lines.groupBy("run").transformWithStateInPandas(
        RunStatus(deadline_ms, of_silence), "run string, status string, iteration int", "Update", "ProcessingTime" if deadline_ms else "None"
    )
