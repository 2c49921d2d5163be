"""Objects of JSON arrays by byte ranges against the json module."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import profiler
from corpusmill.plans import profiler as plans
from corpusmill.sources.json_elements import json_elements

TEXTS = ["", "a", '"', "\\", '\\"', "{[", "]}", '"traceEvents": [', "é漢", "\\\\\\", "x" * 40, "\n\t"]


def value(rng: random.Random, depth: int):
    kind = rng.randrange(6 if depth else 4)
    if kind == 4:
        return [value(rng, depth - 1) for _ in range(rng.randrange(4))]
    if kind == 5:
        return {rng.choice(TEXTS) + str(k): value(rng, depth - 1) for k in range(rng.randrange(4))}
    return [None, rng.randrange(-9, 999), rng.choice(TEXTS), rng.random() < 0.5][kind]


@pytest.mark.parametrize("span", [2, 17, 100, 1 << 20])
def test_elements(spark, tmp_path, span: int) -> None:
    rng, want = random.Random(6), []
    for k in range(2 if span < 10 else 6):
        events = [value(rng, 3) if rng.random() < 0.2 else {"i": i, "v": value(rng, 3), "args": {"traceEvents": [{"no": 1}]}} for i in range(rng.randrange(8))]
        whole = {"before": [{"x": [1]}, "\\"], rng.choice(TEXTS): value(rng, 2), "traceEvents": events, "after": [{"y": 2}], "end": "]}"}
        (tmp_path / f"t{k}.json").write_text(json.dumps(whole, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5), encoding="utf-8")
        want += [(f"t{k}.json", json.dumps(e, sort_keys=True)) for e in events if isinstance(e, dict)]
    (tmp_path / "empty.json").write_text("")
    rows = json_elements(spark, str(tmp_path), "traceEvents", span).orderBy("file", "at").collect()
    assert [(r.file.split("/")[-1], json.dumps(json.loads(r.value), sort_keys=True)) for r in rows] == want


def test_one_trace_by_many_tasks(spark, tmp_path, monkeypatch) -> None:
    monkeypatch.setattr("corpusmill.sources.json_elements.SPAN", 500)
    events = [{"ph": "X", "cat": "kernel" if k % 2 else "cpu_op", "name": f"n{k}", "dur": k / 2, "args": {"External id": k, "Input type": ["f"], "Input Dims": [[2, 3], []]}} for k in range(300)]
    (tmp_path / "a.json").write_text(json.dumps({"schemaVersion": 1, "traceEvents": events}))
    out = profiler.read_trace(spark, str(tmp_path / "a.json"))
    rows = out.orderBy("ord").collect()
    assert [(r.file, r.cat, r.name, r.dur, r.ext_id, r.input_types, r.input_dims) for r in rows] == [("a.json", e["cat"], e["name"], e["dur"], str(k), ["f"], ["2x3", ""]) for k, e in enumerate(events)]
    (tmp_path / "cut.json").write_text(json.dumps({"traceEvents": events})[:2000])
    assert profiler.read_trace(spark, str(tmp_path / "cut.json")).count() > 10


def test_trace_files_are_cut_by_orders(spark, sf, monkeypatch) -> None:
    read, sizes = profiler.read_trace, []

    def counted(session, path):
        sizes.extend(r["count"] for r in session.read.text(path).groupBy(F.input_file_name()).count().collect())
        return read(session, path)

    whole = {tuple(r) for r in plans.profiler_trace_file(spark, sf).collect()}
    monkeypatch.setattr(plans, "TRACE_ORDERS", 100)
    monkeypatch.setattr(profiler, "read_trace", counted)
    assert {tuple(r) for r in plans.profiler_trace_file(spark, sf).collect()} == whole
    assert len(sizes) >= 75 and max(sizes) < sum(sizes) / 40
