"""Recursion and spilling of the external suffix sort, at sizes small enough to be entered."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import induced_sort


@pytest.mark.parametrize("seed", range(40))
def test_recursion_and_spill_change_nothing(seed: int) -> None:
    rng = random.Random(seed)
    strings = [bytes(rng.choices(b"abc" if seed % 2 else bytes(range(256)), k=rng.randrange(1, 90))) for _ in range(rng.randrange(1, 9))]
    strings += [strings[0][3:] + strings[-1], strings[0] * 2]
    width = rng.choice([2, 5, 9])
    seen = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
    want = [[i + width <= len(s) and seen[s[i : i + width]] > 1 for i in range(len(s))] for s in strings]
    for base, memory in ((0, 0), (2, 64), (8, 0), (0, 16)):
        got = induced_sort.repeated_starts(strings, width, base, memory)
        assert [np.asarray(g).tolist() for g in got] == want


def test_queues_spill(monkeypatch) -> None:
    spilled = []
    own = induced_sort.Queues._spill
    monkeypatch.setattr(induced_sort.Queues, "_spill", lambda self: (spilled.append(1), own(self))[1])
    induced_sort.repeated_starts([b"mississippi" * 30, b"missing " * 20], 6, 0, 256)
    assert spilled
