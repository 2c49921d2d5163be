"""Elias-Fano sequences and an n-gram trie over them, in memory-mapped levels; every query takes whole arrays."""

from __future__ import annotations

import mmap
import tempfile
from dataclasses import dataclass

import numpy as np

_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_COUNT = _BITS.sum(axis=1).astype(np.int64)
#: Position of the r-th set bit of a byte (8 where it has fewer).
_PLACE = np.where(np.arange(8)[None, :] < _COUNT[:, None], np.argsort(1 - _BITS, axis=1, kind="stable"), 8).astype(np.uint8)
_BLOCK, _WALK = 1 << 16, 6


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Fields of ``width`` bits one after the other, with 8 bytes to spare at the end."""
    parts = []
    for i in range(0, len(values) if width else 0, _BLOCK):
        fields = values[i : i + _BLOCK, None] >> np.arange(width)
        parts.append(np.packbits((fields & 1).astype(np.uint8), bitorder="little"))
    return np.concatenate([*parts, np.zeros(8, np.uint8)])


class Mapped:
    """Arrays written one after the other to an unnamed file and mapped read-only."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        with tempfile.TemporaryFile() as f:
            at = {}
            for name, a in arrays.items():
                f.write(b"\0" * (-f.tell() % 8))
                at[name] = (f.tell(), a.dtype, len(a))
                f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * 8)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.size = len(self.map)
        self.arrays = {name: np.frombuffer(self.map, t, n, start) for name, (start, t, n) in at.items()}


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, with a count of ones before each 64-bit word."""

    n: int
    width: int
    top: int
    low: np.ndarray
    words: np.ndarray
    ones: np.ndarray

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> dict:
        """The fields, for values below ``universe``."""
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        top = universe >> width
        bits = np.zeros(-(-(n + top + 2) // 64) * 64, np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)
        return {"n": n, "width": width, "top": top, "low": _packed(values & ((1 << width) - 1), width), "words": words, "ones": ones}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i * self.width
        any8 = np.ndarray((len(self.low) - 7,), "<u8", buffer=self.low, strides=(1,))
        return (any8[at >> 3] >> (at & 7).astype(np.uint64)).astype(np.int64) & ((1 << self.width) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th one or zero."""
        before = self.ones if one else np.arange(len(self.ones)) * 64 - self.ones
        w = np.searchsorted(before, k, "right") - 1
        rest, word = (k - before[w]).astype(np.uint8), self.words[w] if one else ~self.words[w]
        place = np.zeros(len(k), np.uint8)
        for half in (32, 16, 8):
            count = np.bitwise_count(word & np.uint64((1 << half) - 1))
            above = rest >= count
            rest -= count * above
            step = above * np.uint8(half)
            place += step
            word >>= step
        return w * 64 + place + _PLACE[(word & np.uint64(255)).astype(np.uint8), rest]

    def get(self, i: np.ndarray) -> np.ndarray:
        if 4 * len(i) > self.n:
            return self._all()[i]
        return (self._select(i, True) - i << self.width) | self._low(i)

    def _all(self) -> np.ndarray:
        """Every element: cheaper than single access when many are asked for at once."""
        place = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return (place - i << self.width) | self._low(i)

    def find(self, target: np.ndarray) -> np.ndarray:
        """Index of the first element at least ``target`` if it equals it, else -1.

        The zeros of the unary part lead to the elements with the target's high bits; those are walked by their low bits,
        and where they are many, halved.
        """
        target = np.minimum(target, (self.top + 1 << self.width) - 1)
        high, want = target >> self.width, target & ((1 << self.width) - 1)
        at = np.where(high == 0, 0, self._select(np.maximum(high - 1, 0), False) - (high - 1))
        out, go = np.full(len(target), -1), np.arange(len(target))
        for _ in range(_WALK):
            bit = at[go] + high[go]
            go = go[(self.words[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)]
            low = self._low(at[go])
            out[go[low == want[go]]] = at[go[low == want[go]]]
            go = go[low < want[go]]
            at[go] += 1
        if len(go):
            low, end = at[go], self._select(high[go], False) - high[go]
            last = end.copy()
            while (open_ := np.flatnonzero(low < last)).size:
                middle = low[open_] + last[open_] >> 1
                less = self._low(middle) < want[go[open_]]
                low[open_] = np.where(less, middle + 1, low[open_])
                last[open_] = np.where(less, last[open_], middle)
            some = np.flatnonzero(low < end)
            some = some[self._low(low[some]) == want[go[some]]]
            out[go[some]] = low[some]
        return out


class Level:
    """Children of the nodes of the level above: pointers, and child keys made monotone across parents."""

    @staticmethod
    def encode(parents: int, parent: np.ndarray, key: np.ndarray) -> tuple[dict, dict]:
        """Children sorted by (parent, key); a key counts from the last one of the parent before."""
        pointers = np.searchsorted(parent, np.arange(parents + 1))
        last = np.zeros(len(key), bool)
        if len(key):
            last[-1] = True
            last[:-1] = parent[1:] != parent[:-1]
        steps = np.where(last, key + 1, 0)
        base = np.concatenate([[0], np.cumsum(steps)[:-1]]) if len(key) else steps
        values = base + key
        return EliasFano.encode(pointers, len(key) + 1), EliasFano.encode(values, int(values[-1]) + 1 if len(key) else 1)

    def __init__(self, pointers: EliasFano, keys: EliasFano):
        self.pointers, self.keys = pointers, keys

    def begin(self, parent: np.ndarray) -> np.ndarray:
        return self.pointers.get(parent)

    def find(self, parent: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Node of the child, -1 if there is none; fastest when sorted by parent and key."""
        fresh = np.ones(len(parent), bool)
        fresh[1:] = parent[1:] != parent[:-1]
        group, own = np.cumsum(fresh) - 1, parent[fresh]
        begin, end = self.pointers.get(own), self.pointers.get(own + 1)
        base = np.zeros(len(own), np.int64)
        base[begin > 0] = self.keys.get(begin[begin > 0] - 1) + 1
        some = np.flatnonzero((begin < end)[group])
        group = group[some]
        found = self.keys.find(base[group] + key[some])
        out = np.full(len(parent), -1)
        out[some] = np.where((found >= begin[group]) & (found < end[group]), found, -1)
        return out


#: Quantised log10 values: 16-bit codes of steps below zero.
STEP = 1 / 2048


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-log10 / STEP), 65535).astype(np.uint16)


class Trie:
    """Backoff model of order 3: words, pairs and triples with quantised log10 probability, and backoff of the first two.

    Pairs hang below their first word by their second; triples below their first pair by the rank of their last word
    among the followers of the middle word (every triple's last pair must be there).
    """

    def __init__(self, words: dict[str, np.ndarray], pairs: dict[str, np.ndarray], triples: dict[str, np.ndarray]):
        """words: prob, back; pairs: first, second, prob, back; triples: head, tail (numbers of their two pairs), prob."""
        n = len(words["prob"])
        key = pairs["first"] * n + pairs["second"]
        place, pair = np.arange(len(key)), pairs
        if not (key[1:] >= key[:-1]).all():
            order = np.argsort(key)
            pair = {k: v[order] for k, v in pairs.items()}
            place[order] = np.arange(len(order))
        two = Level.encode(n, pair["first"], pair["second"])
        begin = np.searchsorted(pair["first"], np.arange(n))
        node, tail = place[triples["head"]], place[triples["tail"]]
        rank = tail - begin[pair["first"][tail]] if len(tail) else tail
        order = np.argsort(node * n + rank)
        three = Level.encode(len(place), node[order], rank[order])
        parts = dict(zip(("p2", "k2", "p3", "k3"), (*two, *three), strict=True))
        values = {"w": words["prob"], "wb": words["back"], "q": pair["prob"], "qb": pair["back"], "t": triples["prob"][order]}
        arrays = {k: quantised(v) for k, v in values.items()}
        arrays |= {f"{k}.{f}": e[f] for k, e in parts.items() for f in ("low", "words", "ones")}
        self.mapped = Mapped(arrays)
        a = self.mapped.arrays
        made = {k: EliasFano(e["n"], e["width"], e["top"], *(a[f"{k}.{f}"] for f in ("low", "words", "ones"))) for k, e in parts.items()}
        self.two, self.three = Level(made["p2"], made["k2"]), Level(made["p3"], made["k3"])

    def _value(self, name: str, i: np.ndarray) -> np.ndarray:
        return self.mapped.arrays[name][i] * -STEP

    def score(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """log10 P(third | first second) for arrays of word ids."""
        n = len(first)
        return self.score_pairs(np.concatenate([first, second]), np.concatenate([second, third]), np.arange(n), np.arange(n, 2 * n))

    def score_pairs(self, left: np.ndarray, right: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """log10 P of triples given as two pairs each: numbers in the list of pairs (left, right), looked up once."""
        key = left * (int(right.max(initial=0)) + 1) + right
        pair = np.empty(len(left), np.int64)
        if (key[1:] >= key[:-1]).all():
            pair = self.two.find(left, right)
        else:
            order = np.argsort(key)
            pair[order] = self.two.find(left[order], right[order])
        below, above = pair[tail], pair[head]
        middle = left[tail]
        out = self._value("wb", middle) + self._value("w", right[tail])
        has = np.flatnonzero(below >= 0)
        out[has] = self._value("q", below[has])
        known = np.flatnonzero(above >= 0)
        out[known] += self._value("qb", above[known])
        both = np.flatnonzero((above >= 0) & (below >= 0))
        words = np.arange(int(middle.max(initial=-1)) + 1)
        rank = below[both] - self.two.begin(words)[middle[both]]
        order = np.argsort(above[both] * (int(rank.max(initial=0)) + 1) + rank)
        both, rank = both[order], rank[order]
        full = self.three.find(above[both], rank)
        out[both[full >= 0]] = self._value("t", full[full >= 0])
        return out
