"""The licence scan against plain Python over the fitted model: no pre-filter, no joins."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.ml.functions import vector_to_array

from corpusmill.llm import license_scan as ls


def _triples(tokens: list[str]) -> set:
    return {tuple(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))}


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


@pytest.fixture(scope="module")
def docs(spark, sf):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(1000 + i, f"Some words in front.\n{t}\nAnd behind.", "en", "x") for i, t in enumerate(t for ts in ls.TEMPLATES.values() for t in ts)]
    rows += [(2000 + i, t, "en", "x") for i, t in enumerate(ls.DECOYS)]
    rows += [(3000 + i, " ".join(rng.choice(["license", "public", "the", "of", "terms", "version", "software"]) for _ in range(30)), None, None) for i in range(20)]
    rows += [(None, "Released under the MIT License.", None, None), (4000, "long " * 300_000 + "\nLicensed under the zlib License.", "en", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)


@pytest.fixture(scope="module")
def fitted(docs) -> tuple:
    return ls.train(docs)


@pytest.fixture(scope="module")
def found(docs, fitted) -> dict[tuple, tuple]:
    return {(r.doc_id, r.family): (r.n_paragraphs, r.least_probability) for r in ls.families(docs, fitted).collect()}


def test_families_against_plain_python(docs, found, fitted) -> None:
    got = found
    model, temperature = fitted
    names = [ls.UNKNOWN, *ls.TEMPLATES]
    known = [(f, _triples(_words(t))) for f, ts in ls.TEMPLATES.items() for t in ts]
    rows = model.transform(ls.featured(ls.paragraphs(docs))).select("doc_id", "tokens", vector_to_array("rawPrediction").alias("raw"))
    want: dict[tuple, list[float]] = {}
    for r in rows.toLocalIterator():
        top = max(r.raw)
        family, share = names[r.raw.index(top)], 1 / sum(math.exp((z - top) / temperature) for z in r.raw)
        if family == ls.UNKNOWN or share < ls.LEAST_PROBABILITY:
            continue
        own = _triples(r.tokens)
        if any(f == family and (100 * len(own & t) >= ls.CONFIRM_PERCENT * len(t) or (len(own) >= 3 and 3 * len(own & t) >= 2 * len(own))) for f, t in known):
            want.setdefault((r.doc_id, family), []).append(share)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k][0] == len(v) and got[k][1] == pytest.approx(min(v))


def test_notices_are_named_and_decoys_are_not(found) -> None:
    notices = [f for f, ts in ls.TEMPLATES.items() for _ in ts]
    named = sum((1000 + i, f) in found for i, f in enumerate(notices))
    assert named >= 0.9 * len(notices)
    assert not [d for d, _ in found if d is not None and 2000 <= d < 4000]
    assert (None, "MIT") in found and (4000, "Zlib") in found


def test_one_line_marks(spark, fitted) -> None:
    lines = {
        "// SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL",
        " * SPDX-License-Identifier: BSD-3-Clause": "BSD", "SPDX-License-Identifier: CC-BY-NC-SA-4.0": "CC-BY-NC-SA", "-- SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
    }
    rows = [(i, f"int x;\n{line}\nint y;", "en", "x") for i, line in enumerate(lines)] + [(99, "SPDX-License-Identifier: none of these", "en", "x")]
    got = {(r.doc_id, r.family) for r in ls.families(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), fitted).collect()}
    assert got == set(enumerate(lines.values()))


def test_whole_templates_are_held_back(spark, docs) -> None:
    rows = ls.training_rows(docs).select("label", "tokens", "held").collect()
    # The held template of a family, and whatever was cut from it, is on no other row of the family.
    for label, family in enumerate(ls.TEMPLATES, 1):
        own = [r for r in rows if r.label == label]
        assert {r.held for r in own} == {True, False}
        held = _words(ls.TEMPLATES[family][1])
        for r in own:
            is_cut = any(r.tokens[k:] == held[: len(r.tokens) - k] and len(r.tokens) - k in {len(held), max(3, len(held) // 2), max(3, len(held) * 3 // 4)} for k in (0, 1))
            others = [_words(t) for i, t in enumerate(ls.TEMPLATES[family]) if i != 1]
            shared = any(r.tokens[k:] == o[: len(r.tokens) - k] for o in others for k in (0, 1))
            assert r.held == is_cut or shared
    assert 0 < sum(r.held for r in rows if r.label == 0) < sum(r.label == 0 for r in rows)
