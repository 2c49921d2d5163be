"""Streams that run: growing files, deadlines, bounded state."""

from __future__ import annotations

import json
import time

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corpusmill.sources import tailing
from corpusmill.streaming import jobs


@pytest.mark.parametrize("chunk", [1, 5, 1000])
@pytest.mark.parametrize("split", [1, 3, 7, 1000])
def test_spans_share_out_lines(tmp_path, chunk: int, split: int) -> None:
    data = b"ab\n\n\ncdefgh\n" + "é\n".encode() + b"x" * 20 + b"\nlast"
    (tmp_path / "f").write_bytes(data)
    store, path = tailing.opened(str(tmp_path / "f"))
    want, at = [], 0
    for part in data.split(b"\n"):
        want.append((at, part))
        at += len(part) + 1
    for upto in (len(data), len(data) - 4):
        spans = [tailing.Span(path, a, min(a + split, upto), upto, a == 0) for a in range(0, upto, split)]
        assert [x for s in spans for x in tailing.lines(store, s, chunk)] == [w for w in want if w[0] < upto]
    for size in range(len(data) + 1):
        assert tailing.line_end(store, path, size, 0) == data[:size].rfind(b"\n") + 1


def _texts(spark, out: str) -> list[str]:
    return sorted(r.text for r in spark.read.schema("text string").parquet(out).collect())


def _start(spark, folder, out, state, idle=None):
    rows = jobs.text_stream(spark, str(folder), idle=idle)
    put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    return rows.writeStream.foreachBatch(put).option("checkpointLocation", str(state)).trigger(processingTime="100 milliseconds").start()


def _until(holds, seconds: float = 120) -> None:
    end = time.monotonic() + seconds
    while not holds():
        assert time.monotonic() < end
        time.sleep(0.2)


def test_growing_file_over_a_restart(spark, tmp_path, monkeypatch) -> None:
    folder, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    out.mkdir()
    line = lambda k: json.dumps({"text": f"text {k}"}) + "\n"
    query = _start(spark, folder, out, state)  # the folder is not there yet
    folder.mkdir()
    (folder / "_hidden").write_text(line(99))
    with (folder / "a.jsonl").open("w") as f:
        f.write(line(0) + "\n" + '{"other": 1}\n' + line(1)[:7])
        f.flush()
        _until(lambda: _texts(spark, str(out)) == ["text 0"])
        f.write(line(1)[7:] + line(2))
        f.flush()
        _until(lambda: _texts(spark, str(out)) == ["text 0", "text 1", "text 2"])
        f.write(line(3)[:9])
        f.flush()
        time.sleep(1)
        query.stop()
        f.write(line(3)[9:] + "\r\n" + line(4).rstrip())
    (folder / "b.jsonl").write_text(line(5))
    query = _start(spark, folder, out, state, idle=3)  # the last line has no end: the file counts as finished after a while
    jobs.run_until_idle(query, 6)
    assert _texts(spark, str(out)) == [f"text {k}" for k in range(6)]
    jobs.run_until_idle(_start(spark, folder, out, state, idle=3), 2)  # it is finished after a restart, too
    assert _texts(spark, str(out)) == [f"text {k}" for k in range(6)]
    with (folder / "a.jsonl").open("a") as f:
        f.write("more\n")
    with pytest.raises(StreamingQueryException, match="has changed before"):
        jobs.run_until_idle(_start(spark, folder, out, state), 60)


def _lines(spark, folder, rows) -> None:
    spark.createDataFrame(rows, "run string, line_no int, value string").coalesce(1).write.mode("append").parquet(folder)


def _status(spark, folder, out, state, deadline, of_silence=True):
    lines = spark.readStream.schema("run string, line_no int, value string").parquet(folder)
    put = lambda batch, n: batch.withColumn("n", F.lit(n)).write.mode("overwrite").parquet(f"{out}/batch={n}")
    return jobs.status_stream(lines, deadline, of_silence).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", state).trigger(processingTime="200 milliseconds").start()


def _latest(spark, out: str) -> dict:
    rows = spark.read.schema("run string, status string, iteration int, n int").parquet(out)
    return {r.run: (r.status, r.iteration) for r in rows.groupBy("run").agg(F.max_by("status", "n").alias("status"), F.max_by("iteration", "n").alias("iteration")).collect()}


def test_a_silent_run_times_out_by_itself(spark, tmp_path) -> None:
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "out").mkdir()
    _lines(spark, folder, [("a", 2, " iteration 5/ 9"), ("a", 1, " iteration 4/ 9"), ("b", 1, " iteration 3/ 9"), ("c", 1, "iteration 1/ 9 | grad norm: nan")])
    query = _status(spark, folder, out, state, 12_000)
    _until(lambda: len(_latest(spark, out)) == 3)
    query.stop()  # the status and the timers outlive a restart
    _lines(spark, folder, [("a", 3, "x")])
    query = _status(spark, folder, out, state, 12_000)
    _until(lambda: _latest(spark, out)["b"] == ("timeout", 3))
    assert _latest(spark, out)["a"] == ("running", 5)  # its lines came later
    _until(lambda: _latest(spark, out)["a"] == ("timeout", 5))
    assert _latest(spark, out)["c"] == ("nan", 1)
    query.stop()


def test_a_run_that_talks_on_has_a_deadline(spark, tmp_path) -> None:
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "out").mkdir()
    _lines(spark, folder, [("a", 0, " iteration 1/ 9")])
    query = _status(spark, folder, out, state, 4_000, of_silence=False)

    def over() -> bool:
        _lines(spark, folder, [("a", 1, "talk")])
        rows = spark.read.schema("run string, status string").parquet(out).filter("status = 'timeout'")
        return rows.count() > 0

    _until(over)
    query.stop()


def test_status_of_lines_in_any_order() -> None:
    frame = lambda *rows: pd.DataFrame(rows, columns=["line_no", "value"])
    state = (-1, 0, "running")
    for rows in ([(9, " iteration 9/ 20"), (4, " iteration 4/ 20")], [(5, " iteration 5/ 20"), (7, "x")]):
        state = jobs.classified(state, frame(*rows))
    assert state == (9, 9, "running")
    state = jobs.classified(state, frame((3, "iteration 3/ 20 | grad norm: nan")))
    assert state == (9, 9, "nan")
    assert jobs.classified(state, frame((12, "torch.OutOfMemoryError")))[2] == "oom"


def test_changed_steps_over_batches(spark, tmp_path) -> None:
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "port long, ord long, step long"
    for rows in ([(1, 0, 5), (1, 1, 5), (2, 0, None)], [(1, 2, 5), (1, 3, 6), (2, 1, None), (3, 0, 1)], [(1, 1, 6), (3, 5, 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.changed_sink(spark.readStream.schema(schema).parquet(folder), out, state).awaitTermination()
    got = sorted((r.port, r.ord) for r in spark.read.parquet(f"{out}/rows").collect())
    assert got == [(1, 0), (1, 3), (2, 0), (3, 0)]


def test_state_is_that_of_live_ports(spark, tmp_path) -> None:
    """Over many batches, of which each has a new port and an old one, the state and what a batch reads stay as they are."""
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema, sizes = "port long, ord long, step long", []
    for k in range(24):
        spark.createDataFrame([(100 + k, 0, 1), (1, k, k // 2)], schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.changed_sink(spark.readStream.schema(schema).parquet(folder), out, state, live=3).awaitTermination()
        files = list((tmp_path / "out" / "state" / f"slot={k % 2}").glob("*.parquet"))
        sizes.append((spark.read.parquet(*map(str, files)).count(), len(list((tmp_path / "out" / "state").iterdir()))))
    assert sizes[2:] == [(4, 2)] * 22  # port 1 and the new ones of three batches
    assert spark.read.parquet(f"{out}/rows").filter("port = 1").count() == 12
