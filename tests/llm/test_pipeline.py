"""The pipeline against plain Python, stage by stage over the smallest tables, and by itself."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from corpusmill.llm import decontaminate as d3
from corpusmill.llm import quality_rules as q8
from corpusmill.llm.tables import table

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _counts(text: str) -> dict:
    ws = WORD.findall(text)
    seen = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    covered = {p for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "_q_lines": len(lines), "_q_chars": len(text)}


def quality(docs: list[dict]) -> list[dict]:
    counts = [_counts(d["text"] or "") for d in docs]
    fine = [c["n_words"] >= 50 and 100 * c["n_repeat_words"] <= 50 * c["n_words"] for c in counts]
    cut = lambda v: v >> max(v.bit_length() - 12, 0) << max(v.bit_length() - 12, 0)
    bins = [{r: cut(1000 * c[a] // max(c[b], 1)) for r, (a, b, _, _) in q8.RATES.items()} for c in counts]
    own, whole = defaultdict(list), defaultdict(list)
    for d, b, f in zip(docs, bins, fine, strict=True):
        if f:
            for r, v in b.items():
                own[d["lang"], d["source"], r].append(v)
                whole[d["lang"], r].append(v)

    def quartile(values: list[int], k: int) -> int:
        values = sorted(values)
        return values[-(-k * len(values) // 4) - 1]

    kept = []
    for d, b, f in zip(docs, bins, fine, strict=True):
        for r, (_, _, least, low) in q8.RATES.items():
            group, all_ = own[d["lang"], d["source"], r], whole[d["lang"], r]
            if f:
                q1, q2, q3 = ((len(group) * quartile(group, k) + 30 * quartile(all_, k)) // (len(group) + 30) for k in (1, 2, 3))
                reach = q8.FENCE * max(q3 - q1, least)
                f = b[r] <= q2 + reach and not (low and b[r] < q2 - reach)
        if f:
            kept.append(d)
    return kept


def near_duplicates(docs: list[dict]) -> list[dict]:
    def shingles(text: str) -> set:
        ws = WORD.findall((text or "").translate(LOWER))
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    docs = sorted(docs, key=lambda d: d["doc_id"])
    sets, root = [shingles(d["text"]) for d in docs], list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [d for i, d in enumerate(docs) if not sets[i] or find(i) == i]


def repeated_text(docs: list[dict]) -> list[dict]:
    texts = [(d["text"] or "").encode() for d in docs]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for d, t in zip(docs, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        if not gone.any():
            out.append(d)
        elif not gone.all():
            text = bytes(b for b, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")
            out.append(d | {"text": text, "n_chars": len(text)})
    return out


def leaks(spark, docs: list[dict], bench) -> set:
    """Documents that hold half of an item's template windows or more, by plain Python over the tokens."""
    rows = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "i long, text string")
    tokens = lambda df, i: {r[0]: r[1] for r in df.select(i, d3.template(d3.marked(df["text"]))).collect()}
    of = lambda t: {tuple(t[k : k + d3.WINDOW]) for k in range(len(t) - d3.WINDOW + 1)}
    items = [w for t in tokens(bench, "item_id").values() if (w := of(t or []))]
    return {i for i, t in tokens(rows, "i").items() if any(100 * len(w & of(t or [])) >= d3.MIN_PERCENT * len(w) for w in items)}


@pytest.fixture(scope="module")
def stages(spark, sf) -> list[list[dict]]:
    docs, out = table(spark, sf, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        got = [r.asDict() for r in stage(spark, docs, sf).collect()]
        out.append(sorted(got, key=lambda d: d["doc_id"]))
        docs = spark.createDataFrame([tuple(d[c] for c in docs.columns) for d in got], docs.schema)
    return out


def test_each_stage_on_its_own_input(spark, sf, stages) -> None:
    docs = [r.asDict() for r in table(spark, sf, "documents").collect()]
    by_id = lambda ds: sorted(ds, key=lambda d: d["doc_id"])
    assert stages[0] == by_id(quality(docs))
    assert stages[1] == near_duplicates(stages[0])
    assert stages[2] == by_id(repeated_text(stages[1]))
    gone = {d["doc_id"] for d in stages[2]} - {d["doc_id"] for d in stages[3]}
    assert gone <= leaks(spark, stages[2], table(spark, sf, "benchmark"))
    assert all(d in stages[2] for d in stages[3])
    assert [{k: v for k, v in d.items() if k not in ("token_ids", "n_tokens")} for d in stages[4]] == stages[3]


def test_every_leak_goes(spark, sf, stages) -> None:
    gone = {d["doc_id"] for d in stages[2]} - {d["doc_id"] for d in stages[3]}
    assert gone == leaks(spark, stages[2], table(spark, sf, "benchmark"))


def test_run_is_its_stages(spark, sf, stages) -> None:
    got = sorted((r.doc_id, r.n_tokens, list(r.token_ids)) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == [(d["doc_id"], d["n_tokens"], list(d["token_ids"])) for d in stages[-1]]
