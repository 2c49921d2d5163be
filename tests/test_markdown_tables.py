"""Markdown tables against plain Python that goes line by line and character by character."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import markdown_tables as mt


def _row(line: str) -> bool:
    bare = line.strip()
    return len(bare) > 1 and bare[0] == bare[-1] == "|"


def _fold(cell: str) -> str:
    return re.sub(mt.NUMBER_SIGN, r"##\1", "".join(mt.PLAIN.get(c, c) for c in cell))


def _cells(line: str) -> list[str]:
    bare = line.strip()
    return [_fold(c.strip()) for c in bare[bare[0] == "|" : len(bare) - (bare[-1] == "|" and len(bare) > 1)].split("|")]


def _shares(names: list[str], rows: list[list[str]], max_row: int, max_col: int | None) -> list[int]:
    n = len(names)
    longest = lambda t: max(map(len, t.split(" ")))
    natural = [max([1, len(names[i]), *(len(r[i]) for r in rows)]) for i in range(n)]
    least = [max([1, longest(names[i]), min(16, max([0, *(longest(r[i]) for r in rows)]))]) for i in range(n)]
    room = max(n, max_row - 3 * n - 1)
    limit = [room if max_col is None else max(least[i], max_col) for i in range(n)]
    w = [max(least[i], min(limit[i], round(room * natural[i] / sum(natural)))) for i in range(n)]
    for _ in range(sum(w) - room):
        k = max(range(n), key=lambda i: (w[i] - least[i], -i))
        w[k] -= w[k] > least[k]
    for _ in range(room - sum(w)):
        open_ = [i for i in range(n) if w[i] < natural[i]] or [i for i in range(n) if w[i] < limit[i]]
        if open_:
            w[max(open_, key=lambda i: (natural[i], -i))] += 1
    return w


def _wrap(text: str, width: int) -> list[str]:
    out: list[str] = []
    for word in text.split():
        for piece in [word[i : i + width] for i in range(0, len(word), width)]:
            if out and len(out[-1]) + 1 + len(piece) <= width:
                out[-1] += " " + piece
            else:
                out.append(piece)
    return out


def _reflow(text: str | None, max_row: int, max_col: int | None) -> str | None:
    if text is None:
        return None
    lines, out, i = text.splitlines(), [], 0
    while i < len(lines):
        if not (i + 1 < len(lines) and _row(lines[i]) and re.match(mt.RULE, lines[i + 1])):
            out.append(lines[i])
            i += 1
            continue
        head, i, rows = _cells(lines[i]), i + 2, []
        while i < len(lines) and _row(lines[i]):
            rows.append((_cells(lines[i]) + [""] * len(head))[: len(head)])
            i += 1
        names = []
        for k, name in enumerate(head):
            names.append((name or " ") + (f"\u200b{head[:k].count(name)}" if name in head[:k] else ""))
        widths = _shares(names, rows, max_row, max_col)
        for k, row in enumerate([head, *(rows or [[""] * len(head)])]):
            parts = [_wrap(c, w) for c, w in zip(row, widths, strict=True)]
            for part in range(max(1, *map(len, parts))):
                out.append("| " + " | ".join((p[part] if part < len(p) else "").ljust(w) for p, w in zip(parts, widths, strict=True)) + " |")
            if k == 0:
                out.append("|" + "|".join("-" * (w + 2) for w in widths) + "|")
    return "\n".join(out) + ("\n" if text.endswith("\n") else "")


LINES = ["", "text", "| a | b |", "|---|---|", "---|:---:", "|:-|---|", "| x | long words here | more |", "|one|", "|", "||", "  | pad |\t", "--- | ---"]
CELLS = ["", "a", "name", "name", "two words", "see #12 and #1234", "https://an.address/of/some/length/and/more", "→ “x” ≤ y…", "many short words in a row here", "é ü"]


def _made(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randrange(1, 4)):
        n = rng.randrange(1, 6)
        out += ["before"] * rng.randrange(2)
        out += ["|" + "|".join(f" {rng.choice(CELLS)} " for _ in range(n)) + "|", "|" + "|".join(["---"] * max(2, n)) + "|"]
        out += ["|" + "|".join(f" {rng.choice(CELLS)} " for _ in range(max(1, n + rng.randrange(-1, 2)))) + "|" for _ in range(rng.randrange(4))]
    return "\n".join(out) + "\n" * rng.randrange(2)


@pytest.mark.parametrize(("max_row", "max_col"), [(80, None), (40, None), (30, 12), (5, None), (120, 20)])
def test_reflow_against_plain_python(spark, max_row: int, max_col: int | None) -> None:
    rng = random.Random(max_row)
    texts = [None, "", "\n", "no table", "| a | b |\n|---|---|", "| a | b |\r\n|---|---|\r\n| c | d |\r\n", "| a | a | a |\n|---|---|---|\n| 1 |\n", "|  |  |\n|---|---|\n"]
    texts += ["\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 15))) for _ in range(300)] + [_made(rng) for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    got = {r.id: r.text for r in mt.reflowed(rows, max_row, max_col).collect()}
    for i, text in enumerate(texts):
        assert got[i] == _reflow(text, max_row, max_col), (text, got[i])


def test_chains_of_bare_rules(spark) -> None:
    text = "\n".join(["| a | b |", "---|---"] * 5 + ["| c | d |", "| e | f |"])
    assert mt.reflowed(spark.createDataFrame([(1, text)], "id long, text string"), 30).first().text == _reflow(text, 30, None)


def test_empty_and_long(spark) -> None:
    empty = spark.createDataFrame([], "id long, text string")
    assert mt.reflowed(empty).count() == 0
    text = "| n | what |\n|---|---|\n" + "".join(f"| {i} | {'word ' * 30}|\n" for i in range(3000))
    assert mt.reflowed(spark.createDataFrame([(1, text)], "id long, text string")).first().text == _reflow(text, 80, None)
    assert mt.reflowed(spark.range(1).select("id", F.lit("| a").alias("text"))).first().text == "| a"


def test_a_reflowed_text_is_shuffled_once(spark) -> None:
    rows = spark.createDataFrame([(1, "| a | b |\n|---|---|\n| c | d |")], "id long, text string")
    plan = mt.reflowed(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "Window" not in plan


def test_widths_are_found_without_a_shuffle(spark) -> None:
    rows = spark.createDataFrame([(1, "| a | b |\n|---|---|\n| c | dd |"), (2, None), (3, "no table")], "id long, text string")
    widths = mt.allotted(mt.column_widths(mt.tables(rows)), 60)
    assert "Exchange" not in widths._jdf.queryExecution().executedPlan().toString()
    assert [(r.id, r.head, r.naturals, r.mins) for r in widths.collect()] == [(1, 0, [1, 2], [1, 2])]
