"""Signature trees over sets of 64-bit hashes: OR-combined bitmaps and size ranges, dual traversal, union-find.

A node stands for some sets of one block.  ``Block.join`` walks pairs of nodes and leaves out a pair when the largest
possible overlap of any of its sets is too small for the Jaccard bound, when sizes cannot fit, or when all its sets are
in one component already.  The result is a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

LEAF = 16


def bits_of(n: int) -> int:
    """Width of the bitmap of a set of n: a power of two of at least 2 n bits, so sets of like size fold onto each other."""
    return max(256, 1 << (2 * n - 1).bit_length())


def bitmap(hashes: np.ndarray) -> bytes:
    width = bits_of(len(hashes))
    at = np.zeros(width, np.bool_)
    at[(hashes >> np.uint64(3)) & np.uint64(width - 1)] = True
    return np.packbits(at, bitorder="little").tobytes()


def folded(m: np.ndarray) -> np.ndarray:
    half = m.shape[1] // 2
    return m[:, :half] | m[:, half:]


class Node:
    __slots__ = ("either", "high", "kids", "low", "members", "slack")

    def __init__(self, members: np.ndarray, bitmaps: np.ndarray, sizes: np.ndarray, slack: np.ndarray):
        own = bitmaps[members]
        self.members, self.low, self.high = members, int(sizes[members].min()), int(sizes[members].max())
        self.either, self.slack, self.kids = np.bitwise_or.reduce(own, axis=0), int(slack[members].max()), ()
        if len(members) > LEAF:
            # Nearest half of a pivot's bits first: like sets share a subtree.
            far = np.bitwise_count(own ^ own[0]).sum(axis=1)
            order = members[np.argsort(far, kind="stable")]
            half = len(order) // 2
            self.kids = (Node(order[:half], bitmaps, sizes, slack), Node(order[half:], bitmaps, sizes, slack))


class Block:
    """Sets of one block: ids, sizes and bitmaps; ``percent`` is the Jaccard bound in percent."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], percent: int):
        self.sizes, self.percent = sizes.astype(np.int64), percent
        self.root = list(range(len(sizes)))
        self.of: dict[int, np.ndarray] = {}
        self.maps: dict[tuple[int, int], np.ndarray] = {}
        widths = np.array([len(b) for b in bitmaps])
        self.row = np.zeros(len(sizes), np.int64)
        for w in np.unique(widths):
            at = np.flatnonzero(widths == w)
            self.of[int(w)], self.row[at] = at, np.arange(len(at))
            full = np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(len(at), -1)
            self.maps[int(w), int(w)] = full
            if w > 32:
                self.maps[int(w), int(w) // 2] = folded(full)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def _enough(self, overlap, total):
        return (100 + self.percent) * overlap >= self.percent * total

    def _pairs(self, a: Node, b: Node, ma: np.ndarray, mb: np.ndarray, same: bool) -> Iterator[tuple[int, int]]:
        """Pairs of two leaves whose largest possible overlap is enough."""
        left, right = ma[self.row[a.members]], mb[self.row[b.members]]
        both = np.bitwise_count(left[:, None, :] & right[None, :, :]).sum(axis=2).astype(np.int64)
        na, nb = self.sizes[a.members][:, None], self.sizes[b.members][None, :]
        most = np.minimum(na - np.bitwise_count(left).sum(axis=1)[:, None], nb - np.bitwise_count(right).sum(axis=1)[None, :]) + both
        fit = self._enough(np.minimum(most, np.minimum(na, nb)), na + nb)
        if same:
            fit &= np.tri(len(a.members), k=-1, dtype=bool)
        i, j = np.nonzero(fit)
        order = np.argsort(-(most[i, j] / (na + nb)[i, j]), kind="stable")
        return zip(a.members[i[order]].tolist(), b.members[j[order]].tolist(), strict=True)

    def _one(self, a: Node, b: Node) -> bool:
        first = self.find(int(a.members[0]))
        return all(self.find(i) == first for i in a.members.tolist()) and all(self.find(i) == first for i in b.members.tolist())

    def join(self, check: Callable[[int, int], bool] | None = None) -> Iterator[tuple[int, int]]:
        """Unites sets whose bound fits (and ``check`` holds); yields the pairs that united two components."""
        for wa in sorted(self.of):
            for wb in (wa, 2 * wa):
                if wb in self.of:
                    yield from self._cross(wa, wb, check)

    def _cross(self, wa: int, wb: int, check) -> Iterator[tuple[int, int]]:
        ma, mb = self.maps[wa, wa], self.maps[wb, wa]
        trees = []
        for w, m in ((wa, ma), (wb, mb)):
            at = self.of[w]
            slack = self.sizes[at] - np.bitwise_count(m).sum(axis=1).astype(np.int64)
            trees.append(self._shift(Node(np.arange(len(at)), m, self.sizes[at], slack), at))
            if wa == wb:
                trees *= 2
                break
        todo = [(trees[0], trees[1])]
        while todo:
            a, b = todo.pop()
            if 100 * a.high < self.percent * b.low or 100 * b.high < self.percent * a.low:
                continue
            most = int(np.bitwise_count(a.either & b.either).sum()) + min(a.slack, b.slack)
            if not self._enough(most, a.low + b.low) or self._one(a, b) and (len(a.members) > 1 or a is not b):
                continue
            if a.kids or b.kids:
                if a is b:
                    x, y = a.kids
                    todo += [(x, y), (y, y), (x, x)]
                elif a.kids and (not b.kids or len(a.members) >= len(b.members)):
                    todo += [(x, b) for x in a.kids]
                else:
                    todo += [(a, y) for y in b.kids]
                continue
            for i, j in self._pairs(a, b, ma, mb, a is b):
                p, q = self.find(i), self.find(j)
                if p != q and (check is None or check(i, j)):
                    self.root[max(p, q)] = min(p, q)
                    yield i, j

    def _shift(self, node: Node, at: np.ndarray) -> Node:
        """Members as positions in the block."""
        node.members = at[node.members]
        for x in node.kids:
            self._shift(x, at)
        return node
