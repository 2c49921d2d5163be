"""A counting quotient filter over fingerprints of ``width`` bits, built and read in bulk.

A fingerprint is split into a quotient, its home slot, and a remainder, which is what a slot stores.  Remainders of one quotient
stand together in ascending order (a run), moved right where their home is taken; one bit for each home tells whether it has a
run, one bit for each slot whether a run ends there.  A count above one follows its remainder in counter slots (a third bit),
lowest digit first, so hot fingerprints cost a slot or two.  Nothing is lost: the filter gives back every fingerprint with its
count in ascending order, which is what merging needs.
"""

from __future__ import annotations

import struct

import numpy as np

#: Slots filled at most, as a share of the homes.
LOAD = 0.75
_HEAD = struct.Struct("<BBQQ")


def _merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values with summed counts; sorted stretches are merged, not sorted again."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[first], (np.add.reduceat(counts, first) if len(first) else counts)


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints and how often each occurs."""
    return _merged(values.astype(np.uint64), np.ones(len(values), np.uint64))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several (fingerprints, counts) as one, counts summed."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _merged(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def encode(values: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """The filter of ascending distinct fingerprints below ``2 ** width`` and their counts (1 at least)."""
    q = min(max(0, int(np.ceil(np.log2(max(len(values), 1) / LOAD)))), width - 1)
    r = width - q
    mask = np.uint64((1 << r) - 1)
    home = (values >> np.uint64(r)).astype(np.int64)
    digits, extra, left = [], np.zeros(len(values), np.int64), counts - np.uint64(1)  # digits of count - 1
    while left.any():
        digits.append(left & mask)
        extra += left > 0
        left = left >> np.uint64(r)
    need = 1 + extra
    before = np.cumsum(need) - need
    at = np.maximum.accumulate(home - before) + before  # its home, or the first slot after the one before
    slots = max(1 << q, int(at[-1] + need[-1])) if len(values) else 1 << q
    remainders = np.zeros(slots, np.uint64)
    occupied, ends, counters = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
    remainders[at] = values & mask
    for k, digit in enumerate(digits):
        has = extra > k
        remainders[at[has] + 1 + k] = digit[has]
        counters[at[has] + 1 + k] = True
    occupied[home] = True
    last = np.concatenate([home[1:] != home[:-1], [True]]) if len(values) else np.zeros(0, bool)
    ends[(at + need - 1)[last]] = True
    size = -(-r // 8)
    packed = remainders.astype("<u8").view(np.uint8).reshape(slots, 8)[:, :size]
    bits = b"".join(np.packbits(b).tobytes() for b in (occupied, ends, counters))
    return _HEAD.pack(q, width, slots, len(values)) + bits + packed.tobytes()


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The filter's fingerprints in ascending order, and their counts."""
    q, width, slots, _ = _HEAD.unpack_from(data)
    r, place, bits = width - q, _HEAD.size, []
    for n in (1 << q, slots, slots):
        size = -(-n // 8)
        bits.append(np.unpackbits(np.frombuffer(data, np.uint8, size, place), count=n).astype(bool))
        place += size
    size = -(-r // 8)
    wide = np.zeros((slots, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, slots * size, place).reshape(slots, size)
    remainders = wide.view("<u8").ravel().astype(np.uint64)
    homes, ends = np.flatnonzero(bits[0]), np.flatnonzero(bits[1])
    if not len(homes):
        return merged([])
    starts = np.maximum(homes, np.concatenate([[0], ends[:-1] + 1]))
    lengths = ends - starts + 1
    slot = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    home, counter = np.repeat(homes, lengths), bits[2][slot]
    values = (home[~counter].astype(np.uint64) << np.uint64(r)) | remainders[slot[~counter]]
    counts = np.ones(len(values), np.uint64)
    item = np.cumsum(~counter) - 1
    place = slot - slot[~counter][item] - 1
    for k in range(int(place[counter].max()) + 1 if counter.any() else 0):
        here = counter & (place == k)
        counts[item[here]] += remainders[slot[here]] << np.uint64(k * r)
    return values, counts
