"""The ten operators against brute force, on small fixtures with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import chaining, decontaminate, kneser_ney, license_scan, lm_score, ngram_join, piece_codec, quality_rules, suffix_dedup, warc

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seed int, d string, pos int, key string, n int, bits string, window string, anchor int, row int, chunk string, i int, t string, j int, k int, _i int, _id int, _t string, _s int, mark string, _c int, _q int, lines int, _rank int, shard int, code int, task int"
CLASH = (1, "x", 2, "y", 3, "z", "w", 4, 5, "c", 6, "t", 7, 8, 9, 10, "u", 11, "m", 12, 13, 14, 15, 16, 17, 18)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows: list[tuple]):
    """Rows (doc_id, text) with every other column that an operator might trip over."""
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}", len(t or ""), *CLASH) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    shared, long = prose(rng, 70), prose(rng, 6000)
    near = base[3].split()
    near[len(near) // 2 : len(near) // 2 + 1] = ["other"]
    texts = [*base, base[0], base[0], " ".join(near), shared + " " + prose(rng, 40), prose(rng, 30) + " " + shared, long, long + " tail", None, "", "  \n\t ", "one", "ONE", "Grüße – 漢字 " + prose(rng, 60), "a" * 450, "b" + "a" * 300]
    out = list(enumerate(texts))
    return [*out, out[0], (None, texts[5]), (None, None)]


def shingles(text: str | None) -> set:
    ws = WORD.findall((text or "").translate(LOWER))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def test_suffix_dedup(spark, rows) -> None:
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in suffix_dedup.removed_spans(frame(spark, rows)).collect())
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    want = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        want.append((i is None, i or 0, len(t), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_ngram_join(spark, rows) -> None:
    found = ngram_join.components(frame(spark, rows))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found.collect()))
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            name[find(i)] = min(name.get(find(i), d), d)
    want = sorted((d is None, d or 0, len(sets[i]), name.get(find(i), -1) if sets[i] else (-1 if d is None else d)) for i, (d, _) in enumerate(rows))
    assert got == want


def test_ngram_survivors(spark, rows) -> None:
    kept = ngram_join.survivors(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 1 and ids[30] == ids[31] == 0


def test_quality_counts(spark, rows) -> None:
    out = quality_rules.with_counts(frame(spark, rows))
    for r in out.select("text", *quality_rules.COUNTS, "base_failed").collect():
        text = r.text or ""
        ws = WORD.findall(text)
        seen = Counter(zip(ws, ws[1:], ws[2:], strict=False))
        covered = {p for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert tuple(r[1:6]) == want
        assert r.base_failed == (len(ws) < 50 or 100 * len(covered) > 50 * len(ws))


def test_quality_passing(spark) -> None:
    rng = random.Random(1)
    good = [(i, prose(rng, 80, 2000)) for i in range(60)]
    junk = [(100 + i, " ".join(f"w{rng.randrange(2000)}###$$$" for _ in range(80))) for i in range(3)]
    kept = quality_rules.passing(frame(spark, [*good, *junk, (None, None)]))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in good}
    assert kept.columns == frame(spark, good).columns


def test_warc_round_trip(spark, tmp_path) -> None:
    page = "<html>" + "long enough to be worth a revisit " * 5 + "</html>"
    pages = [(1, "http://a/x y", page), (2, "http://b", page), (3, None, "tiny"), (4, "", "tiny"), (5, "http://c", None), (6, "http://d", "ü" * 60), (None, "http://e", page)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    warc.write_archives(df, str(tmp_path / "w"))
    got = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert len(got) == len(pages)
    for i, _, html in pages:
        body = (html or "").encode()
        assert got[i].payload_bytes == len(body) and got[i].payload_digest == hashlib.sha256(body).hexdigest()
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 1) if html == page and i != 1 else ("response", None))
        if got[i].record_type == "response":
            assert bytes(got[i].payload) == body


def test_warc_rejects_broken_archives() -> None:
    raw = warc.record_bytes(1, "http://a", b"payload", hashlib.sha256(b"payload").hexdigest(), False, None)
    assert warc.parse_record(raw)["payload"] == b"payload"
    for broken in (raw[:-1], raw.replace(b"payload", b"pay1oad"), raw.replace(b"WARC/1.1", b"WARX/1.1"), raw.replace(b"WARC-Type", b"WARC-Tipe")):
        with pytest.raises(ValueError, match="."):
            warc.parse_record(broken)
    with pytest.raises(ValueError, match="magic"):
        list(warc.frames_of(memoryview(b"no frame at all")))


def test_pieces_round_trip(spark, rows) -> None:
    texts = [*rows, (90, "mark ▁ and \x00 byte"), (91, " lead  double\n\n")]
    out = piece_codec.round_trip(frame(spark, texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.decoded == r.text
        assert (r.token_ids is None) == (r.text is None) and r.n_tokens == len(r.token_ids or [])


def test_pieces_are_the_best() -> None:
    pieces = piece_codec.load_pieces()
    words = sorted({" the", " station", " stationed", " x", "\n", "  ", " ▁"})
    for word, ids in zip(words, piece_codec.best_pieces(words, pieces), strict=True):
        best = {0: 0.0}
        for end in range(1, len(word) + 1):
            best[end] = best[end - 1] + pieces.unknown_score
            for start in range(end):
                if (p := pieces.ordinary.get(word[start:end])) and best[start] + p[1] > best[end]:
                    best[end] = best[start] + p[1]
        score = {i: s for i, s in pieces.ordinary.values()}
        if all(i in score for i in ids):
            assert sum(score[i] for i in ids) == pytest.approx(best[len(word)])


def test_pieces_are_those_of_the_model(spark, sf) -> None:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL_PATH)
    rng = random.Random(7)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r.text and "▁" not in r.text]
    texts += ["the government of the station", " lead  double   three\n\n" + " " * 70 + "x", "a" * 300, "naïve 梦 \x07 🙂 1234567"]
    texts += ["".join(rng.choice("theinsraoa  \n") for _ in range(n)) for n in (5, 60, 400, 3000)]
    texts += ["".join(rng.choice("theinsraoa") for _ in range(n)) for n in (40, 48, 49, 2000)]
    ids, ends = piece_codec.Encoder(piece_codec.load_pieces()).encode(texts)
    for text, got in zip(texts, np.split(ids, ends[:-1]), strict=True):
        assert got.tolist() == model.encode(text), text[:80]


def test_lm_scores(spark, rows) -> None:
    out = lm_score.scores(frame(spark, rows)).collect()
    toks = [[*WORD.findall((t or "").translate(LOWER)), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for ts, h in zip(toks, held, strict=True):
        if not h:
            seq = ["<", "<", *ts]
            c1.update(ts)
            c2.update(zip(seq, seq[1:], strict=False))
            c3.update(zip(seq, seq[1:], seq[2:], strict=False))
    n, v = sum(c1.values()), len(c1)
    c1["<"] = held.count(False)
    want = []
    for (i, _), ts, h in zip(rows, toks, held, strict=True):
        seq, base, score = ["<", "<", *ts], 0.0, 0.0
        for a, b, w in zip(seq, seq[1:], seq[2:], strict=False):
            p1 = (c1[w] + 1) / (n + v + 1)
            p2 = (c2[b, w] + lm_score.MU[0] * p1) / (c1[b] + lm_score.MU[0])
            base += math.log10(p1)
            score += math.log10((c3[a, b, w] + lm_score.MU[1] * p2) / (c2[a, b] + lm_score.MU[1]))
        want.append((-1 if i is None else i, h, len(ts), sum(c1[t] > 0 for t in ts), n, round(base, 6), score))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score) for r in out)
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6], abs=0.002 * w[2] + 0.01)


def test_kneser_ney_sums_to_one(spark) -> None:
    rng = random.Random(2)
    texts = frame(spark, [(i, prose(rng, 50, 40)) for i in range(20)]).select("text")
    grams, contexts = kneser_ney.model(texts)
    shard = kneser_ney.Shard(grams.toArrow(), contexts.toArrow(), 0, 1)
    for context in (b"\0\0\0\0", b" w1 ", b"w12 ", b"zzzz"):
        code = (int.from_bytes(context, "big") << 8) + np.arange(256)
        assert (10.0 ** shard.score(code)).sum() == pytest.approx(1, abs=1e-4)


def test_classifier(spark) -> None:
    rng = random.Random(3)
    good = [(i, prose(rng, 60, 90)) for i in range(60)]
    junk = [(100 + i, "".join(rng.choice("#$%&QXZ!") for _ in range(300))) for i in range(4)]
    docs = frame(spark, [*good, *junk, (200, None), (201, ""), good[0]])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = kneser_ney.classify(docs, labels).collect()
    assert len(out) == len(good) + len(junk) + 3
    assert {r.doc_id for r in out if r.kept} == {i for i, _ in good}
    grams, contexts = kneser_ney.model(kneser_ney.trusted(docs, labels))
    one = sorted((r.doc_id, r.n_bytes, round(r.loss or 0, 9)) for r in kneser_ney.losses(docs, grams, contexts).collect())
    many = sorted((r.doc_id, r.n_bytes, round(r.loss or 0, 9)) for r in kneser_ney.losses(docs, grams, contexts, 3000).collect())
    assert one == many


def test_all_trusted_texts_are_counted(spark) -> None:
    docs = spark.range(200_500).selectExpr("id as doc_id", "concat('t', id) as text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 1000 = 7, 0, 1) as quality")
    assert kneser_ney.trusted(docs, labels).count() == 200_500 - 201


def test_decontaminate(spark) -> None:
    item = "A train leaves Berlin at 9 and travels 120 km in 2 hours, how fast does the train go on average"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    other = item.replace("Berlin", "Madrid").replace("120", "450").replace(" 9 ", " 7 ").replace(" 2 ", " 3 ")
    rng = random.Random(4)
    docs = [(1, prose(rng, 30) + " " + item + " " + prose(rng, 30)), (2, "so. " + other), (3, prose(rng, 80)), (4, None), (5, ""), (6, item), (6, item)]
    got = {r.doc_id: r.kind for r in decontaminate.hits(frame(spark, docs), bench).collect()}
    assert got == {1: "verbatim", 2: "reparameterised", 6: "verbatim"}
    assert {r.doc_id for r in decontaminate.clean(frame(spark, docs), bench).collect()} == {3, 4, 5}


def test_decontaminate_parts_short_items_and_slots(spark) -> None:
    rng = random.Random(9)
    letters = lambda n: " ".join("".join(rng.choices("bcdfgaeiou", k=7)) for _ in range(n))
    long, ask = letters(120).split(), "What is the capital of Peru"
    apples = "Anna has 5 apples and her brother has 5 pears, so how many of them are on the table"
    plums = "Tom sold 3 plums while his sister sold 4 plums, so how many plums did they sell in all"
    bench = spark.createDataFrame([(1, " ".join(long)), (2, ask), (3, apples), (4, plums)], "item_id long, text string")
    around = lambda t: letters(30) + " " + t + " " + letters(30)
    look_alike = apples.replace("5 apples", "7 apples").replace("5 pears", "9 pears")
    docs = {
        1: around(" ".join(long[40:80])), 2: around(" ".join(long[40:53])), 3: around(" ".join(long[40:52])),
        4: around(ask), 5: around("what is the capital"), 6: around(look_alike), 7: around(apples.replace("5 pears", "6 pears")),
        8: around(plums.replace("3", "5").replace("4", "5")), 9: look_alike + " " + letters(9) + " " + apples,
    }
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.hits(frame(spark, list(docs.items())), bench).collect()}
    assert got == {
        (1, 1): "verbatim", (2, 1): "verbatim", (4, 2): "verbatim", (6, 3): "reparameterised", (7, 3): "reparameterised",
        (8, 4): "reparameterised", (9, 3): "verbatim",
    }


def test_chaining(spark) -> None:
    rng = random.Random(6)
    shared = prose(rng, 80, 5000).split()
    fuzzy = list(shared)
    for i in (20, 45, 60):
        fuzzy[i] = "changed"
    docs = [(i, prose(rng, 100, 5000)) for i in range(10)]
    docs += [(30, "same " * 70 + prose(rng, 30, 5000)), (31, prose(rng, 30, 5000) + " same" * 90)]
    docs += [(20, prose(rng, 40, 5000) + " " + " ".join(shared)), (21, " ".join(fuzzy) + " " + prose(rng, 50, 5000)), (22, docs[0][1]), (23, None), (24, ""), (25, "few words here"), (26, "few words here"), (None, " ".join(shared))]
    got = {r.doc_id: r for r in chaining.repeated(frame(spark, docs)).collect()}
    assert set(got) == {0, 20, 21, 22, 30, 31, None}
    assert got[0].n_covered == got[0].n_words == 100
    assert 50 <= got[21].n_covered <= 90


def test_chains_against_all_predecessors() -> None:
    rng = random.Random(8)
    for _ in range(30):
        n = rng.randrange(1, 40)
        x, y = [rng.randrange(60) for _ in range(n)], [rng.randrange(60) for _ in range(n)]
        order, score = sorted(range(n), key=lambda i: (x[i], y[i])), {}
        for i in order:
            before = [score[j] - chaining.GAP * (x[i] - x[j] + y[i] - y[j]) for j in score if x[j] < x[i] and y[j] < y[i]]
            score[i] = chaining.K + max([0.0, *before])
        best = chaining.chains(x, y)[0]
        own = chaining.K * len(best) - chaining.GAP * (x[best[-1]] - x[best[0]] + y[best[-1]] - y[best[0]])
        assert own == pytest.approx(max(score.values()))
        assert sorted(i for c in chaining.chains(x, y) for i in c) == list(range(n))


def test_license_scan(spark) -> None:
    rng = random.Random(9)
    docs = [(i, prose(rng, 40) + "\n" + prose(rng, 30)) for i in range(20)]
    docs += [(30, "Intro\nReleased under the MIT License.\n"), (31, license_scan.TEMPLATES["GPL"][1]), (32, "She lost her driving license under the bridge."), (33, None), (34, "\n\n"), (35, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.")]
    got = {(r.doc_id, r.family) for r in license_scan.families(frame(spark, docs)).collect()}
    assert got == {(30, "MIT"), (31, "GPL"), (35, "CC-BY-NC"), (35, "Apache-2.0")}


def test_empty_tables(spark) -> None:
    none = frame(spark, [(1, "x")]).filter("doc_id > 5")
    bench, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert suffix_dedup.removed_spans(none).count() == 0
    assert suffix_dedup.cleaned(none).count() == 0
    assert ngram_join.components(none).count() == 0
    assert ngram_join.survivors(none).count() == 0
    assert decontaminate.hits(none, bench).count() == 0
    assert quality_rules.passing(none).count() == 0
    assert piece_codec.round_trip(none).count() == 0
    assert chaining.repeated(none).count() == 0
    assert lm_score.scores(none).count() == 0
    assert kneser_ney.classify(none, labels).count() == 0
    assert license_scan.families(none).count() == 0


def test_pieces_with_a_small_cache(sf, spark, monkeypatch) -> None:
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    whole, small = (piece_codec.Encoder(piece_codec.load_pieces()) for _ in range(2))
    want = [whole.encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(piece_codec, "CACHE_BYTES", 50_000)
    assert [small.encode([t])[0].tolist() for t in texts] == want
    assert len(small.known) < len(whole.known)
