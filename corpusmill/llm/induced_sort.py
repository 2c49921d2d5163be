"""External induced suffix sorting with common-prefix values, over one shard of byte strings.

Suffixes are induced from the sorted LMS suffixes bucket by bucket.  The priority queues are monotone (a bucket's keys
arrive in order), so each is a list of runs of (position, common prefix with the entry before) per leading symbol;
runs beyond ``MEMORY_BYTES`` are written to a temporary file and read back once, when their bucket's turn comes.  The
order of the LMS suffixes comes from naming LMS substrings and sorting the reduced string: by this same induction when
it has more than ``BASE`` symbols, else directly in memory.  Common prefixes count up to ``cap`` (at most 254) symbols and the order
is exact up to that depth, which is all that finding repeats of ``cap`` bytes needs.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY_BYTES = 64 << 20
BASE = 1 << 24


class Queues:
    """Runs of (positions, prefixes) by bucket; the oldest runs spill to disk."""

    def __init__(self, memory: int = 0):
        self.memory, self.held, self.file = memory or MEMORY_BYTES, 0, None
        self.runs: dict[int, list] = {}

    def push(self, bucket: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.runs.setdefault(bucket, []).append((positions, prefixes))
        self.held += positions.nbytes + prefixes.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.runs.values():
            for i, run in enumerate(runs):
                if isinstance(run[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(run[0].tobytes())
                    self.file.write(run[1].tobytes())
                    runs[i] = (at, len(run[0]))
        self.held = 0

    def take(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a bucket in order, removed from the queue."""
        runs = self.runs.pop(bucket, [])
        out = []
        for a, b in runs:
            if isinstance(a, np.ndarray):
                self.held -= a.nbytes + b.nbytes
                out.append((a, b))
            else:
                self.file.seek(a)
                out.append((np.frombuffer(self.file.read(4 * b), np.int32), np.frombuffer(self.file.read(b), np.uint8)))
        if not out:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8)
        return (out[0] if len(out) == 1 else tuple(np.concatenate(x) for x in zip(*out, strict=True)))  # type: ignore[return-value]


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]) for each pair, ends included, by a table of power-of-two runs."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] + 1 - (1 << k)])
        table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > 1 << k else table[:0]
    return out


def _runs(text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position the end of its run of equal symbols, and whether its suffix is of type S."""
    last = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    sizes = np.diff(np.append(-1, last))
    rises = np.ones(len(last), bool)
    rises[:-1] = text[last[:-1] + 1] > text[last[:-1]]
    return np.repeat(last + 1, sizes).astype(np.int32), np.repeat(rises, sizes)


def _name(text: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank (number of smaller ones) of each LMS substring text[lms .. ends], ended ones after those that go on."""
    top = int(text.max(initial=0)) + 2
    width = int(top).bit_length()
    per = max(1, 62 // width)
    rank = np.zeros(len(lms), np.int64)
    at, offset = np.arange(len(lms)), 0
    while len(at):
        key = np.zeros(len(at), np.int64)
        for k in range(per):
            p = lms[at] + offset + k
            symbol = text[np.minimum(p, len(text) - 1)].astype(np.int64)
            key = key << width | np.where(p <= ends[at], symbol, top)
        order = np.lexsort((key, rank[at]))
        group, key = rank[at][order], key[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        begins = np.flatnonzero(fresh)
        sizes = np.diff(np.append(begins, len(order)))
        # A group starts at its old rank plus the number of its members that sort before.
        outer = np.ones(len(order), bool)
        outer[1:] = group[1:] != group[:-1]
        start = np.maximum.accumulate(np.where(outer, np.arange(len(order)), 0))
        value = np.repeat(group[begins] + begins - start[begins], sizes)
        rank[at[order]] = value
        offset += per
        more = (lms[at] + offset <= ends[at])[order]
        go = np.repeat(np.logical_or.reduceat(more, begins) & (sizes > 1), sizes)
        at = at[order][go]
    return rank


def _direct(rank: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of ranks, by doubling; ties beyond ``depth`` symbols stay in text order."""
    n, h = len(rank), 1
    rank = rank.astype(np.int64)
    at = np.arange(n)
    order = np.argsort(rank, kind="stable")
    while len(at) and h < depth:
        follow = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        perm = np.lexsort((follow, rank[at]))
        group, follow = rank[at][perm], follow[perm]
        outer = np.ones(len(perm), bool)
        outer[1:] = group[1:] != group[:-1]
        fresh = outer.copy()
        fresh[1:] |= follow[1:] != follow[:-1]
        start = np.maximum.accumulate(np.where(outer, np.arange(len(perm)), 0))
        begins = np.flatnonzero(fresh)
        sizes = np.diff(np.append(begins, len(perm)))
        where = at[perm]
        rank[where] = np.repeat(group[begins] + begins - start[begins], sizes)
        at = where[np.repeat(sizes > 1, sizes)]
        h *= 2
    order = np.argsort(rank, kind="stable")
    return order


def _seed_prefixes(text: np.ndarray, left: np.ndarray, seeds: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each seed with the one before; ``left`` holds the symbols before each position's end mark."""
    out = np.zeros(len(seeds), np.int64)
    if len(seeds) < 2:
        return out.astype(np.uint8)
    a, b = seeds[:-1].astype(np.int64), seeds[1:].astype(np.int64)
    most = np.minimum(np.minimum(left[a], left[b]), cap)
    same, at = np.zeros(len(a), np.int64), np.arange(len(a))
    step = 8 // text.itemsize
    padded = np.append(text, np.zeros(step, text.dtype))
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(text), 8), (text.itemsize, 1))
    block = np.ascontiguousarray(words).view(np.uint64).ravel()
    while len(at):
        x, y = block[np.minimum(a[at] + same[at], len(text) - 1)], block[np.minimum(b[at] + same[at], len(text) - 1)]
        diff = x ^ y
        # Little-endian words: the lowest set bit tells how many symbols agree.
        low = (diff & (~diff + np.uint64(1))).astype(np.float64)
        equal = np.where(diff == 0, step, (np.frexp(low)[1] - 1) // (8 * text.itemsize))
        same[at] += equal
        at = at[(equal == step) & (same[at] < most[at])]
    out[1:] = np.minimum(same, most)
    return out.astype(np.uint8)


class Induction:
    """Suffix order of ``text`` (integers; every 0 is an end mark, equal to no other) with prefixes up to ``cap``."""

    def __init__(self, text: np.ndarray, cap: int, base: int = 0, memory: int = 0):
        self.text, self.cap, self.n = text, cap, len(text)
        self.base, self.memory = base or BASE, memory
        self.run_end, self.rises = _runs(text, self.n)
        marks = np.flatnonzero(text == 0)
        self.left = (np.repeat(marks, np.diff(np.append(-1, marks))) - np.arange(self.n)).astype(np.int32)
        self.symbols = np.unique(text).tolist()

    def seeds(self) -> np.ndarray:
        """LMS positions in suffix order."""
        lms = np.flatnonzero(self.rises[1:] & ~self.rises[:-1]) + 1
        is_mark = self.text[lms] == 0
        ends = np.append(lms[1:], self.n - 1)
        ends = np.where(is_mark, lms, np.minimum(ends, lms + self.left[lms]))
        names = _name(self.text, lms, ends)
        names[is_mark] = np.arange(int(is_mark.sum()))  # end marks are all different, in text order
        if len(lms) <= self.base or len(lms) * 2 > self.n:
            return lms[_direct(names, self.cap // 2 + 2)]  # an LMS substring moves on by two symbols at least
        # The reduced string's end marks are 0 again, as in the text; other names keep their order from 1.
        compact = np.unique(names[~is_mark], return_inverse=True)[1] + 1
        reduced = np.zeros(len(lms), np.int64)
        reduced[~is_mark] = compact
        order = [p for p, _ in Induction(reduced, self.cap, self.base, self.memory).ordered()]
        rest = np.concatenate(order)[::-1] if order else np.zeros(0, np.int64)
        return lms[np.concatenate([np.flatnonzero(is_mark), rest])]

    def _spread(self, queues: Queues, gaps: np.ndarray, seen: np.ndarray, at: np.ndarray, prefix: np.ndarray, wanted: np.ndarray) -> None:
        """Pushes the predecessors of the entries where ``wanted``, each with its prefix with the entry pushed before it."""
        chosen = np.flatnonzero(wanted)
        if len(at):
            whole = prefix.min()
        if len(chosen):
            before = self.text[at[chosen] - 1]
            order = np.argsort(before, kind="stable")
            index, bucket = chosen[order], before[order]
            first = np.ones(len(index), bool)
            first[1:] = bucket[1:] != bucket[:-1]
            low = np.where(first, 0, np.append(0, index[:-1] + 1))
            least = range_minima(prefix, low, index)
            least[first] = np.minimum(least[first], gaps[bucket[first]])
            value = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
            starts = np.flatnonzero(first)
            heads = bucket[starts]
            value[starts[~seen[heads]]] = 0
            seen[heads] = True
            positions = (at[index] - 1).astype(np.int32)
            np.minimum(gaps, whole, out=gaps)
            tails = np.append(starts[1:], len(index)) - 1
            after = index[tails] + 1
            rest = np.full(len(tails), 255, np.uint8)
            some = np.flatnonzero(after < len(at))
            rest[some] = range_minima(prefix, after[some], np.full(len(some), len(at) - 1))
            gaps[heads] = rest
            for s, e, b in zip(starts.tolist(), (tails + 1).tolist(), heads.tolist(), strict=True):
                queues.push(b, positions[s:e], value[s:e])
        elif len(at):
            np.minimum(gaps, whole, out=gaps)

    def _meet(self, a: int, b: int) -> int:
        """Common prefix of an L and an S suffix of one bucket: the shorter run of their symbol."""
        return min(int(self.run_end[a]) - a, int(self.run_end[b]) - b, self.cap)

    def ordered(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, prefix with the entry before) of each bucket but the end marks', from the last bucket to the first
        in descending order; a bucket's first prefix is 0."""
        text, size = self.text, int(self.text.max(initial=0)) + 1
        seeds = self.seeds()
        seed_prefix = _seed_prefixes(text, self.left, seeds, self.cap)
        seed_bounds = np.searchsorted(text[seeds], np.append(self.symbols, size))
        low, fallen = Queues(self.memory), Queues(self.memory)
        gaps, seen = np.zeros(size, np.uint8), np.zeros(size, bool)
        for k, c in enumerate(self.symbols):
            last, first_run = -1, True
            while c and c in low.runs:
                at, prefix = low.take(c)
                if first_run:
                    prefix = prefix.copy()
                    prefix[0] = 0
                fallen.push(c, at, prefix)
                first_run, last = False, int(at[-1])
                self._spread(low, gaps, seen, at, prefix, (at > 0) & (text[at - 1] >= c))
            at = seeds[seed_bounds[k] : seed_bounds[k + 1]]
            if len(at):
                prefix = seed_prefix[seed_bounds[k] : seed_bounds[k + 1]].copy()
                prefix[0] = self._meet(last, int(at[0])) if last >= 0 else 0
                self._spread(low, gaps, seen, at, prefix, np.ones(len(at), bool))
        high = Queues(self.memory)
        gaps, seen = np.zeros(size, np.uint8), np.zeros(size, bool)
        for c in reversed(self.symbols):
            if c == 0:
                break
            out, last = [], -1
            while c in high.runs:
                at, prefix = high.take(c)
                if not out:
                    prefix = prefix.copy()
                    prefix[0] = 0
                out.append((at, prefix))
                last = int(at[-1])
                self._spread(high, gaps, seen, at, prefix, (at > 0) & (text[at - 1] <= c))
            at, prefix = fallen.take(c)
            if len(at):
                at, back = at[::-1], np.zeros(len(prefix), np.uint8)
                back[1:] = prefix[:0:-1]
                back[0] = self._meet(int(at[0]), last) if last >= 0 else 0
                out.append((at, back))
                self._spread(high, gaps, seen, at, back, (at > 0) & (text[at - 1] < c))
            if out:
                yield tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[misc]


def repeated_starts(strings: list[bytes], width: int, base: int = 0, memory: int = 0) -> list[np.ndarray]:
    """For each string, whether its ``width``-byte substring at each position starts at another place of any string too."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    text = np.zeros(int(sizes.sum()), np.uint16)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
    text[: len(joined)] = joined
    text += 1
    text[begins[1:] - 1] = 0
    hit = np.zeros(len(text), bool)
    if len(strings):
        for at, prefix in Induction(text, width, base, memory).ordered():
            near = np.flatnonzero(prefix >= width)
            hit[at[near]] = hit[at[near - 1]] = True
    return [hit[a : b - 1] for a, b in zip(begins[:-1], begins[1:], strict=True)]
