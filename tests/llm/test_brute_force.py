"""Operators 2 and 3 against plain Python that shares nothing with them but their fixed values."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
import regex

from corpusmill.llm import decontaminate as d3
from corpusmill.llm import kneser_ney as k2
from corpusmill.llm import queries


class KneserNey:
    """Interpolated modified Kneser-Ney over bytes, by recursion over dictionaries."""

    def __init__(self, texts: list[bytes]):
        grams = [Counter() for _ in range(6)]
        for t in texts:
            padded = b"\0" * 4 + t
            grams[5].update(padded[i : i + 5] for i in range(len(t)))
        for k in range(4, 0, -1):
            grams[k].update(g[1:] for g in grams[k + 1])
        self.grams, self.followers, self.cut = grams, [defaultdict(dict) for _ in range(6)], [None] * 6
        for k in range(1, 6):
            n = Counter(min(c, 5) for c in grams[k].values())
            usual, own = (0.5, 1.0, 1.5), None
            if n[1] and n[2] and n[3]:
                y = n[1] / (n[1] + 2 * n[2])
                own = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
            self.cut[k] = [u if own is None or not 0 < own[i] < i + 1 else own[i] for i, u in enumerate(usual)]
            for g, c in grams[k].items():
                self.followers[k][g[:-1]][g[-1]] = c

    def p(self, gram: bytes) -> float:
        k = len(gram)
        if not k:
            return 1 / 256
        lower, seen = self.p(gram[1:]), self.followers[k].get(gram[:-1])
        if seen is None:
            return lower
        cut = lambda c: self.cut[k][min(c, 3) - 1]
        total, c = sum(seen.values()), seen.get(gram[-1], 0)
        return ((c - cut(c)) if c else 0.0) / total + sum(map(cut, seen.values())) / total * lower

    def loss(self, text: bytes) -> float:
        padded = b"\0" * 4 + text
        return -sum(math.log10(self.p(padded[i : i + 5])) for i in range(len(text))) / len(text)


def test_losses_against_plain_python(spark) -> None:
    rng = random.Random(12)
    letters = "etaoin shrdlu"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 400)), "en") for i in range(25)] + [(90, "ünï 漢字 ###", "de"), (91, "", "en"), (92, None, None), (93, "a", "en"), (None, text(50), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 15), 0) for i in range(25)], "doc_id long, quality int, toxic int")
    model = KneserNey([t.encode() for i, t, _ in rows if i is not None and i < 15])
    got = {r.doc_id: r.loss for r in k2.classify(docs, labels).collect()}
    for i, t, _ in rows:
        assert got[i] == (pytest.approx(model.loss(t.encode()), abs=1e-6) if t else None)


def tokens(text: str | None) -> list[tuple[str, str]]:
    """(template token, token) of a text: numbers, names inside a sentence and units after a number have types."""
    out: list[tuple[str, str]] = []
    text = regex.sub("[\x01\x02]", " ", text or "")
    for m in regex.finditer(r"[\p{L}\p{N}]+", text):
        word, a = m[0], m.start()
        name = bool(regex.match(r"\p{Lu}\p{Ll}", word)) and bool(regex.search(r"[\p{Ll},;] $", text[max(0, a - 2) : a]))
        parts = regex.split(r"(?<=\p{N})(?=\p{L})", word.lower())
        for n, part in enumerate(parts):
            beside = n > 0 or (out and text[a - 1 : a] == " " and regex.search(r"\p{N}$", text[max(0, a - 2) : max(0, a - 1)]))
            if n == 0 and name:
                out.append(("\x01", "\x01" + part))
            elif beside and part in d3.UNITS.split():
                out.append(("\x02", "\x02" + part))
            else:
                out.append((regex.sub(r"\p{N}+", "0", part), part))
    return out


def windows_of(own: list[tuple], width: int) -> list[tuple]:
    """Of each run of tokens the templates, or the tokens themselves if fewer than three templates hold no placeholder."""
    literal = [not regex.search(r"[0\x01\x02]", t) for t, _ in own]
    return [tuple(x[sum(literal[i : i + width]) < 3] for x in own[i : i + width]) for i in range(len(own) - width + 1) if own]


def hits(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    found, read, cut = set(), [(doc_id, tokens(text)) for doc_id, text in docs], {}
    for item_id, item in items:
        readings = [tokens(item)]
        if item and regex.match(r"\p{Lu}\p{Ll}", item):
            first, *rest = readings[0]
            readings.append([("\x01", "\x01" + first[1]), *rest])
        for own in readings:
            width = min(8, len(own))
            windows = defaultdict(list)
            named = windows_of(own, width)
            for i, w in enumerate(named):
                windows[w].append(i)
            for k, (doc_id, theirs) in enumerate(read):
                lines: dict[int, set[int]] = defaultdict(set)
                if (k, width) not in cut:
                    cut[k, width] = windows_of(theirs, width)
                for j, w in enumerate(cut[k, width] if own else ()):
                    for i in windows.get(w, ()):
                        lines[j - i].add(i)
                held, long = set(), False
                for shift, at in lines.items():
                    covered = sorted({p for i in at for p in range(i, i + width)})
                    slots = [(own[p][1], theirs[p + shift][1]) for p in covered if regex.match(r"[\x01\x02\p{N}]", own[p][1])]
                    agree = 0
                    for a in {a for a, _ in slots}:
                        values = [b for x, b in slots if x == a]
                        agree += max(sum(v in (b, a) for v in values) for b in values)
                    if 2 * agree < len(slots):
                        continue
                    held |= {named[i] for i in at}
                    long |= width == 8 and any(all(i + k in at for k in range(6)) for i in at)
                if held and (long or 100 * len(held) >= 50 * len(windows)):
                    found.add((doc_id, item_id))
    return found


def test_hits_against_plain_python(spark, sf) -> None:
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op3_decontaminate(spark, sf).collect()}
    assert got == hits(docs, items) and got


def test_made_up_hits_against_plain_python(spark) -> None:
    rng = random.Random(13)
    pool = ["the train", "a man", "ran", "5", "12 km", "3 hours", "to Rome", "from Oslo", "and then", "Bob", "cost 7 euro", "each", "day", "9", "pears", "sold"]
    make = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, make(rng.randrange(1, 25)).capitalize()) for i in range(12)] + [(90, None), (91, "")]
    docs = []
    for i in range(60):
        words = (rng.choice(items)[1] or "").split()
        for k in range(len(words)):
            if rng.random() < 0.1:
                words[k] = rng.choice(["4", "Paris", "x", words[k].lower()])
        docs.append((i, f"{make(6)}, {' '.join(words[rng.randrange(0, 4) :])} {make(6)}"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d3.hits(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == hits(docs, items) and len(got) > 10


def test_placeholders_alone_are_no_evidence(spark) -> None:
    numbers = [str(k * k + 3) for k in range(14)]
    items = [(0, "42"), (1, "Paris"), (2, " ".join(numbers)), (3, "the 5 km"), (4, "Bob has 3 cats and 4 dogs"), (5, "7 8 9 10 11 12 13 14 15 16 pears")]
    docs = [
        "we had 7 apples in the bowl", "she went to Rome by train", "1 2 3 4 5 6 7 8 9 10 11 12 13", "a walk of the 7 km there", "in all 42 of them", "off to Paris then",
        "x " + " ".join(numbers) + " y", "run the 5 km now", "so Ann has 5 cats and 9 dogs", "2 3 4 5 6 7 8 9 10 11 pears", "Bob has cats",
    ]
    frame, bench = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d3.hits(frame, bench).collect()}
    assert got == hits(list(enumerate(docs)), items) == {(4, 0), (5, 1), (6, 2), (7, 3), (8, 4)}
    assert {r.doc_id for r in d3.clean(frame, bench).collect()} == {0, 1, 2, 3, 9, 10}
