"""Whitening of embeddings on the leading components, found by Chebyshev-filtered subspace iteration.

Entries c become the whole numbers ``x = floor(64 c) + 1000000``. The fit list holds each distinct x vector once: n
vectors with sums S. Every product with the covariance V is one pass over the staged fit list: a task turns its rows into
``(n x - S) / n`` (the difference is exact in whole numbers), multiplies ``C^T (C Q)`` and gives one ``d x k`` partial sum;
partial sums are added in a tree, so the driver gets at most ``FAN`` of them, of a size that only the dimension decides.

A block of ``top + guard`` columns first takes power steps, with a Lanczos vector beside it that bounds the spectrum from
below. Then rounds follow: the Chebyshev recurrence over ``[lower bound, least Ritz value]`` damps the unwanted part,
QR restores the basis, Rayleigh-Ritz gives values and vectors. A round ends the work when every wanted vector's residual
``|V y - e y|`` is within ``TOLERANCE`` of the largest value, or when rounding lets it shrink no more; the column
``residual`` holds what was reached, relative to the largest value.

Defined cases: vectors that are null or hold null, NaN or infinite entries are dropped, and so are those whose
length is not the commonest one (ties: the longer) and those with an entry of 2^40 or more, which have no exact x. Components
of no variance (below 1e-12 of the trace: fewer vectors than components, equal vectors, an empty table) give no rows.
Null keys stay null; repeated rows give their rows each; other columns are ignored. ``deviation`` is null where it does
not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acosh, ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaria.session import stage

SCALE, SHIFT = 64, 1_000_000
TOP, GUARD = 16, 16
TOLERANCE = 1e-13
LANCZOS_STEPS, MOST_DEGREE, MOST_SPREAD = 10, 16, 1e10
#: Entries of the fit list a partition holds, small tables and large ones, and partial sums added in one place.
SMALL_PART, LARGE_PART, FAN = 1 << 18, 1 << 24, 64
_LARGEST = float(1 << 40)

Apply = Callable[[np.ndarray], np.ndarray]


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < _LARGEST, F.lit(False))), F.lit(False))


def lattice(vector: Column) -> Column:
    """The vector in whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))


def leading(apply: Apply, d: int, top: int = TOP, guard: int = GUARD, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``top`` largest eigenvalues of a symmetric positive operator, their vectors as columns, and the largest
    residual relative to the largest value."""
    k, wanted = min(d, top + guard), min(d, top)
    start = np.random.default_rng(seed).standard_normal((d, k + 1))
    q = np.linalg.qr(start[:, :k])[0]
    q, floor = _power_steps(apply, q, start[:, k] / np.linalg.norm(start[:, k])) if k < d else (q, 0.0)
    w, best, idle = apply(q), np.inf, 0
    while True:
        h = q.T @ w
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        if values[0] <= 0:
            return values[:wanted], q[:, :wanted], 0.0
        residual = float(np.linalg.norm(w[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / values[0])
        idle = 0 if residual < best / 2 else idle + 1
        best = min(best, residual)
        if residual <= TOLERANCE or k == d or idle == 3:
            return values[:wanted], q[:, :wanted], residual
        high = max(float(values[-1]), 1e-12 * float(values[0]))
        q = np.linalg.qr(_filtered(apply, q, w, min(floor, high / 2) if floor >= high else floor, high, float(values[0])))[0]
        w = apply(q)


def _power_steps(apply: Apply, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, float]:
    """A block after some power steps, and a lower bound of the spectrum by Lanczos steps in the same passes."""
    basis, diagonal, beside = [v], [], []
    for _ in range(min(LANCZOS_STEPS, len(v) - 1)):
        w = apply(np.column_stack([q, basis[-1]]))
        z = w[:, -1]
        diagonal.append(float(basis[-1] @ z))
        held = np.array(basis).T
        for _ in range(2):
            z = z - held @ (held.T @ z)
        beside.append(float(np.linalg.norm(z)))
        q = np.linalg.qr(w[:, :-1])[0]
        if beside[-1] <= 1e-12 * max(abs(x) for x in diagonal) or beside[-1] == 0:
            break
        basis.append(z / beside[-1])
    inner = beside[: len(diagonal) - 1]
    least = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(inner, 1) + np.diag(inner, -1))[0]
    return q, max(0.0, float(least) - beside[-1])


def _filtered(apply: Apply, q: np.ndarray, w: np.ndarray, low: float, high: float, largest: float) -> np.ndarray:
    """The block under a Chebyshev polynomial that is small on ``low .. high``, scaled to 1 at ``largest``; ``w`` is V q.

    The degree keeps the largest direction from drowning the least one.
    """
    centre, half = (high + low) / 2, (high - low) / 2
    reach = (largest - centre) / half
    degree = max(2, min(MOST_DEGREE, int(acosh(MOST_SPREAD) / acosh(max(reach, 1.0 + 1e-9)))))
    first = sigma = half / (largest - centre)
    before, now = q, (w - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        beyond = 1.0 / (2.0 / first - sigma)
        before, now = now, (apply(now) - centre * now) * (2 * beyond / half) - (sigma * beyond) * before
        sigma = beyond
    return now


class FitList:
    """The staged distinct vectors, their count, sums and total variance, and passes over them."""

    def __init__(self, vectors: DataFrame, d: int, rows: int):
        parts = max(min(64, ceil(rows * d / SMALL_PART)), ceil(rows * d / LARGE_PART))
        self.d = d
        self.table = stage(vectors.select("x").distinct().coalesce(parts), "fit")
        self.parts = self.table.rdd.getNumPartitions()
        sums = self._pass(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), d + 1, "long")
        self.n, self.sums = int(sums[0]), sums[1:]
        self.variance = float(self._centred(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.n if self.n else 0.0

    def covariance(self, q: np.ndarray) -> np.ndarray:
        """V q by one pass."""
        return self._centred(lambda c: (c.T @ (c @ q)).ravel(), q.size).reshape(q.shape) / self.n

    def moments(self, q: np.ndarray) -> np.ndarray:
        """Covariance of the rows' projections on the columns of q, centred by their own mean."""
        k = q.shape[1]

        def gram(c: np.ndarray) -> np.ndarray:
            z = c @ q
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        found = self._centred(gram, k + k * k) / self.n
        return found[k:].reshape(k, k) - np.outer(found[:k], found[:k])

    def _centred(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        n, sums = self.n, self.sums
        return self._pass(lambda x: of((n * x - sums) / n), size, "double")

    def _pass(self, of: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> np.ndarray:
        """The sum over all batches of a function of their rows."""
        d, dtype = self.d, np.int64 if kind == "long" else np.float64

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, dtype)
            for batch in batches:
                if batch.num_rows:
                    total += of(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d))
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.from_numpy_dtype(dtype)))], ["v"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, dtype)
            for batch in batches:
                for row in batch.column(0):
                    total += row.values.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.from_numpy_dtype(dtype)))], ["v"])

        sums, left = self.table.mapInArrow(partial, f"v array<{kind}>"), self.parts
        while left > FAN:
            left = ceil(left / FAN)
            sums = sums.repartition(left).mapInArrow(added, f"v array<{kind}>")
        return np.sum([np.array(r.v, dtype) for r in sums.collect()] or [np.zeros(size, dtype)], axis=0)


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = TOP, guard: int = GUARD) -> DataFrame:
    """Each usable row's whitened value on each component.

    ``key, component, n, deviation, whitened, explained, identity_error, residual``: components by falling variance from 1;
    ``explained`` is a component's share of the variance, ``deviation`` the row's sum of ``(n x - S)^2``, ``identity_error``
    the largest entry of the whitened fit list's covariance minus the identity.
    """
    good = table.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(usable(F.col("v")))
    kind = good.schema["key"].dataType.simpleString()
    lengths = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).where("d > 0")
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    out = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    rename = lambda df: df.withColumnRenamed("key", key)
    if common is None:
        return rename(table.sparkSession.createDataFrame([], out))
    d = int(common.d)
    rows = good.where(F.size("v") == d).select("key", lattice(F.col("v")).alias("x"))
    fit = FitList(rows, d, int(common.n))
    values, vectors, residual = leading(fit.covariance, d, top, guard) if fit.variance > 0 else (np.zeros(0), np.zeros((d, 0)), 0.0)
    real = values > 1e-12 * max(fit.variance, 0.0)
    values, axes = values[real], vectors[:, real] / np.sqrt(values[real])
    k, n, sums = len(values), fit.n, fit.sums
    if not k:
        return rename(table.sparkSession.createDataFrame([], out))
    error = float(np.abs(fit.moments(axes) - np.eye(k)).max())
    shares = values / fit.variance

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, d)
            apart = n * x - sums
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, dtype=np.int64)),
                _squares(apart).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(((apart / n) @ axes).ravel()),
                pa.array(np.tile(shares, m)),
                pa.array(np.full(m * k, error)),
                pa.array(np.full(m * k, residual)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return rename(rows.mapInArrow(project, out))


def _squares(apart: np.ndarray) -> pa.Array:
    """Exact sums of squares by row; null where a long is too short."""
    largest = int(np.abs(apart).max(initial=0))
    if largest * largest * apart.shape[1] < 1 << 63:
        return pa.array((apart * apart).sum(axis=1), pa.int64())
    sums = [sum(int(c) * int(c) for c in row) for row in apart]
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
