"""Numpy views of Arrow text columns: words, word hashes and rolling byte hashes for a chunk of whole documents.

Everything here runs inside tasks on one chunk of rows (about ``CHUNK_BYTES`` of text, always whole documents), so
memory is bounded by the chunk or by the longest single document.  Hashes are 64-bit and depend on content alone, so
equal text gets equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_U = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit words that spreads all bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_CODES = splitmix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 5
_kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; those of a usual chunk stay with the worker, those of a longer text do not."""
    known = _kept.get("powers")
    if known is None or len(known[0]) < n:
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, CHUNK_BYTES + 1), b, _U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        known = out[0], out[1]
        if n <= CHUNK_BYTES + 1:
            _kept["powers"] = known
    return known[0][:n], known[1][:n]


def text_chunks(column: pa.Array, target: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows holding about ``target`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + target, "right")) - 1)
        end = min(end, n)
        lo, hi = int(offsets[row]), int(offsets[end])
        yield row, end, data[lo:hi], offsets[row : end + 1] - lo
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word ``[^\\x20\\x09-\\x0D]+``; words end with their document."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | first[1:n]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | first[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span's bytes (A-Z lower-cased first if ``lower``)."""
    power, inverse = powers(len(data) + 1)
    codes = _BYTE_CODES[LOWER[data] if lower else data]
    prefix = np.zeros(len(data) + 1, _U)
    np.cumsum(codes * power[: len(data)], out=prefix[1:])
    return splitmix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(_U))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` consecutive 64-bit values (len - width + 1 of them)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = np.zeros(n, _U)
    for i in range(width):
        h = (h ^ values[i : i + n]) * _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(29)
    return splitmix(h)


def byte_window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width``-byte window of ``data``, by doubling; ``width`` is a power of two."""
    h, step = _BYTE_CODES[data], 1
    base = _BASE
    while step < width:
        h = h[:-step] * _U(base) + h[step:]
        base, step = base * base % (1 << 64), 2 * step
    return splitmix(h)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` consecutive values, in two cumulative passes over blocks of ``width``."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])
