"""Embedding whitening: means and covariances by rank-one updates in every partition, merged in a tree, and a symmetric QR solve.

Only one row for each partition (a count, sums, means and co-moments) leaves a task, and these are merged ``FAN`` at a time, so
what reaches the driver is one such row; its size hangs on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import lean, stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Partitions' figures that one task merges.
FAN = 32
_ROW = "n long, sums array<bigint>, mean array<double>, moments array<double>"


class Moments:
    """Count, exact sums, means and summed co-moments of vectors, one after the other."""

    def __init__(self, dim: int, whole: bool = True) -> None:
        self.n, self.sums = 0, np.zeros(dim, np.int64 if whole else np.float64)
        self.mean, self.moments, self._outer = np.zeros(dim), np.zeros((dim, dim)), np.empty((dim, dim))

    def add(self, row: np.ndarray) -> None:
        """Welford's update: the deviation from the old mean times that from the new one."""
        self.n += 1
        off = row - self.mean
        self.mean += off / self.n
        np.multiply(off[:, None], (row - self.mean)[None, :], out=self._outer)
        self.moments += self._outer

    def merge(self, n: int, sums: np.ndarray, mean: np.ndarray, moments: np.ndarray) -> None:
        """The parallel update: the co-moments of both, and of the step between their means."""
        off, total = mean - self.mean, self.n + n
        self.moments += moments + np.outer(off, off) * (self.n * n / total)
        self.mean += off * (n / total)
        self.n, self.sums = total, self.sums + sums

    def record(self) -> pa.RecordBatch:
        row = {"n": self.n, "sums": self.sums.astype(np.int64).tolist(), "mean": self.mean.tolist(), "moments": self.moments.ravel().tolist()}
        kinds = {"n": pa.int64(), "sums": pa.list_(pa.int64()), "mean": pa.list_(pa.float64()), "moments": pa.list_(pa.float64())}
        return pa.RecordBatch.from_pylist([row], pa.schema(list(kinds.items())))


def matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """A list column as a matrix; lists of unlike lengths are an error."""
    lengths = np.diff(column.offsets.to_numpy())
    dim = dim or (int(lengths[0]) if len(lengths) else 0)
    if (lengths != dim).any():
        raise ValueError("the vectors have unlike lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def moments(vectors: DataFrame, seen: Callable[[np.ndarray], np.ndarray] | None = None) -> Moments | None:
    """The moments of column ``x``, or of what ``seen`` makes of its vectors; None if there are none."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch.column("x"), None if own is None or seen else len(own.mean))
            points = (seen(rows) if seen else rows).astype(np.float64)
            own = own or Moments(points.shape[1])
            for row in points:
                own.add(row)
            if not seen:
                own.sums += rows.sum(axis=0)
        if own:
            yield own.record()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for row in batch.to_pylist():
                dim = len(row["mean"])
                own = own or Moments(dim)
                if dim != len(own.mean):
                    raise ValueError("the vectors have unlike lengths")
                own.merge(row["n"], np.array(row["sums"], np.int64), np.array(row["mean"]), np.array(row["moments"]).reshape(dim, dim))
        if own:
            yield own.record()

    parts = stored(vectors.select("x").mapInArrow(lean(gather), _ROW), "whiten-moments")
    while (n := parts.count()) > 1:
        parts = stored(parts.repartition(-(-n // FAN)).mapInArrow(lean(merge), _ROW), "whiten-moments")
    row = parts.first()
    if row is None:
        return None
    out = Moments(len(row.mean))
    out.merge(row.n, np.array(row.sums, np.int64), np.array(row.mean), np.array(row.moments).reshape(len(row.mean), -1))
    return out


def _tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of the tridiagonal form by reflections, and their product as rows."""
    a, n = a.copy(), len(a)
    rows = np.eye(n)
    for k in range(n - 2):
        u = a[k + 1 :, k].copy()
        size = np.linalg.norm(u)
        if size == 0:
            continue
        u[0] += np.copysign(size, u[0])
        u /= np.linalg.norm(u)
        a[k + 1 :, :] -= 2 * np.outer(u, u @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ u, u)
        rows[k + 1 :, :] -= 2 * np.outer(u, u @ rows[k + 1 :, :])
    return np.diag(a).copy(), np.diag(a, 1).copy(), rows


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of a symmetric matrix, and its unit eigenvectors as rows.

    Implicit QR steps with Wilkinson's shift on the tridiagonal form; a side entry that rounding cannot tell from 0 splits it.
    """
    d, e, rows = _tridiagonal(np.asarray(a, np.float64))
    eps, high = np.finfo(np.float64).eps, len(d) - 1
    none = lambda k: abs(e[k]) <= eps * (abs(d[k]) + abs(d[k + 1]))
    while high > 0:
        if none(high - 1):
            e[high - 1] = 0.0
            high -= 1
            continue
        low = high - 1
        while low > 0 and not none(low - 1):
            low -= 1
        half = (d[high - 1] - d[high]) / 2
        shift = d[high] - e[high - 1] ** 2 / (half + np.copysign(np.hypot(half, e[high - 1]), half))
        x, z = d[low] - shift, e[low]
        for k in range(low, high):
            size = np.hypot(x, z)
            c, s = (x / size, z / size) if size else (1.0, 0.0)
            if k > low:
                e[k - 1] = size
            p, side, q = d[k], e[k], d[k + 1]
            d[k], d[k + 1] = c * c * p + 2 * c * s * side + s * s * q, s * s * p - 2 * c * s * side + c * c * q
            e[k] = c * s * (q - p) + (c * c - s * s) * side
            if k < high - 1:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
            rows[[k, k + 1]] = c * rows[k] + s * rows[k + 1], c * rows[k + 1] - s * rows[k]
    order = np.argsort(-d, kind="stable")
    return d[order], rows[order]


@dataclass
class Whitening:
    """A fit: n vectors with sums S, the components' variances and unit directions (rows), the trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x.astype(np.int64) - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n) @ self.vectors.T / np.sqrt(self.values)


def steps(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole steps of 1 / SCALE above -OFFSET / SCALE; rows whose vector is null, empty or holds null or
    non-finite entries go.  An entry that is no 64-bit number of steps is an error."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    return rows.filter((F.size(vector) > 0) & ~bad).select("vec_id", x.alias("x"))


def fit(distinct: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Whitening by the first components of the vectors x; directions without spread (to rounding) are none.  None without rows."""
    own = moments(distinct)
    if own is None:
        return None
    values, vectors = symmetric_qr(own.moments / own.n)
    spread = values > len(values) * np.finfo(np.float64).eps * max(values[0], 0.0)
    values, vectors = values[spread][:most], vectors[spread][:most]
    return Whitening(own.n, own.sums, values, vectors, float(np.trace(own.moments)) / own.n)


def whitened(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of the rows of ``steps``, for each component from 1.

    The fit is over the distinct vectors, each once, however often it occurs.  ``deviation`` (sum of (n * x - S) ** 2) is exact, and
    null where it is no 64-bit number.  Components without spread are left out, so vectors that are all equal, or no rows, give
    none.  Ids may be null or repeat: each row gives its own.  Vectors of unlike lengths are an error.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stored(rows, "whiten-steps")
    distinct = stored(rows.select("x").distinct(), "whiten-distinct")
    model = fit(distinct, most)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    seen = moments(distinct, model.project)
    error = float(np.abs(seen.moments / seen.n - np.eye(len(model.values))).max())
    k, share = len(model.values), model.values / model.trace

    def deviations(off: np.ndarray) -> pa.Array:
        if float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
            return pa.array((off * off).sum(axis=1))
        sums = (off.astype(object) ** 2).sum(axis=1)
        return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x, each = matrix(batch.column("x"), len(model.sums)), pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviations(model.offsets(x)).take(each),
                pa.array(model.project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.record_batch(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(lean(project), schema)
