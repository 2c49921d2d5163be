"""Elias-Fano sequences and the trie against plain lookups."""

from __future__ import annotations

import numpy as np
import pytest

from corpusmill.llm.elias_fano import EliasFano, Trie


@pytest.mark.parametrize(("n", "universe"), [(0, 1), (1, 1), (1, 10), (1000, 50), (1000, 10**7), (5, 10**12), (3000, 3100)])
def test_find_and_get(n: int, universe: int) -> None:
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n))
    own = EliasFano(**EliasFano.encode(values, universe))
    for i in (np.arange(n), np.arange(min(n, 3))):
        assert (own.get(i) == values[i]).all()
    target = np.concatenate([values, rng.integers(0, universe, 500)])
    place = np.searchsorted(values, target)
    there = place < n
    there[there] = values[place[there]] == target[there]
    assert (own.find(target) == np.where(there, place, -1)).all()


def test_find_in_a_dense_run() -> None:
    values = np.concatenate([np.arange(0, 4000, 2), [10**9]])
    own = EliasFano(**EliasFano.encode(values, 10**9 + 1))
    assert (own.find(np.arange(4000)) == np.where(np.arange(4000) % 2 == 0, np.arange(4000) // 2, -1)).all()


def test_trie_backs_off() -> None:
    rng = np.random.default_rng(7)
    text = rng.integers(0, 30, 3000)
    pairs = np.unique(np.stack([text[:-1], text[1:]], 1), axis=0)
    triples = np.unique(np.stack([text[:-2], text[1:-1], text[2:]], 1), axis=0)[::3]
    number = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    words = {"prob": -rng.random(30) * 5, "back": -rng.random(30)}
    two = {"first": pairs[:, 0], "second": pairs[:, 1], "prob": -rng.random(len(pairs)) * 5, "back": -rng.random(len(pairs))}
    three = {"head": np.array([number[a, b] for a, b, _ in triples.tolist()]), "tail": np.array([number[b, c] for _, b, c in triples.tolist()]), "prob": -rng.random(len(triples)) * 5}
    trie = Trie(words, two, three)
    by_triple = {tuple(t): p for t, p in zip(triples.tolist(), three["prob"], strict=True)}
    asked = rng.integers(0, 30, (4000, 3))
    for (a, b, c), got in zip(asked.tolist(), trie.score(*asked.T), strict=True):
        if (a, b, c) in by_triple:
            want = by_triple[a, b, c]
        else:
            want = two["prob"][number[b, c]] if (b, c) in number else words["back"][b] + words["prob"][c]
            want += two["back"][number[a, b]] if (a, b) in number else 0
        assert abs(want - got) < 0.002
