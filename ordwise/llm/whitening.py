"""Embedding whitening with covariances by polarisation.

Components are scaled to integers, so that sums are exact. For every dimension
and every sum of two dimensions the squares of centred values are added up;
``Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2`` then gives every
cross-covariance from variances alone, as an exact fraction that is rounded
once. The assembled matrix goes to ``eigh``.

Values are centred before squaring by the whole number nearest the mean of
their dimension; the rest of the mean, less than one, is taken off exactly
afterwards (``n * sum(y^2) - sum(y)^2`` in whole numbers). Partial sums are
taken per task in 64 bits where a bound on the batch proves that they fit and
in unbounded integers otherwise; Spark adds them as pairs of decimals (high
and low 64 bits), so no sum is rounded or overflows at any table size.

What reaches the driver is one number per dimension or pair of dimensions,
whatever the number of vectors. No step groups rows by a key of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

SCALE = 64
SHIFT = 1_000_000
#: Entries of this size or more have no whole number of 64 bits.
ENTRY_LIMIT = 2.0 ** 56
COMPONENTS = 32
_LOW = 1 << 64


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id long, x array<long>``: rows whose vector is not null and holds
    finite entries only (below 2^56 in size, which a 64-bit ``x`` needs)."""
    def fits(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(ENTRY_LIMIT))

    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return v.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fits)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT).cast("long")).alias("x"))


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _exact(values: np.ndarray, bound: int) -> np.ndarray:
    """``values`` in 64 bits if results up to ``bound`` fit, else as Python
    integers."""
    return values if bound < 1 << 62 else values.astype(object)


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0


def _dimension_sums(x: np.ndarray) -> list[int]:
    return [int(s) for s in _exact(x, _largest(x) * len(x)).sum(axis=0)]


def centre(x: np.ndarray, pivot: list[int]) -> np.ndarray:
    """``x`` less its dimension's whole-numbered centre."""
    p = np.asarray(pivot, np.int64)
    return _exact(x, _largest(x) + _largest(p)) - p


def pair_squares(y: np.ndarray) -> list[int]:
    """Sums of ``y_i ^ 2`` and of ``(y_i + y_j) ^ 2``, for ``i <= j``, row by
    row of the upper triangle."""
    y = _exact(y, 4 * _largest(y) ** 2 * max(1, len(y)))
    out: list[int] = []
    for i in range(y.shape[1]):
        pair = y[:, i:] + y[:, i:i + 1]
        pair[:, 0] = y[:, i]
        out += [int(s) for s in (pair * pair).sum(axis=0)]
    return out


def _sums(rows: DataFrame, d: int, size: int, of: Callable[[np.ndarray], list[int]]) -> list[int]:
    """Exact sums over all rows of ``size`` whole numbers made from each
    batch: one row per number and task, added up by Spark."""
    def partial(batches) -> Iterator:
        import pyarrow as pa
        total = [0] * size
        for b in batches:
            total = [a + c for a, c in zip(total, of(_matrix(b.column(0), d)))]
        number = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([Decimal(t // _LOW) for t in total], number),
             pa.array([Decimal(t % _LOW) for t in total], number)], names=["k", "hi", "lo"])

    parts = rows.select("x").mapInArrow(partial, "k int, hi decimal(38,0), lo decimal(38,0)")
    out = [0] * size
    for r in parts.groupBy("k").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect():
        out[r["k"]] = int(r["hi"]) * _LOW + int(r["lo"])
    return out


def covariances(n: int, sums: list[int], squares: list[int], d: int) -> np.ndarray:
    """The covariance matrix (divisor ``n``) from sums of centred values and of
    their pair squares: exact differences of variances, rounded once each."""
    var = {}
    k = 0
    for i in range(d):
        for j in range(i, d):
            total = sums[i] if i == j else sums[i] + sums[j]
            var[i, j] = n * squares[k] - total * total
            k += 1
    v = np.empty((d, d))
    for i, j in var:
        cross = var[i, i] if i == j else (var[i, j] - var[i, i] - var[j, j]) // 2
        v[i, j] = v[j, i] = cross / (n * n)
    return v


@dataclass
class Whitening:
    """A fitted whitening: everything is of the size of the dimensions."""

    dimension: int
    n: int
    pivot: list[int]
    sums: list[int]            # of values less pivot
    covariance: np.ndarray
    eigenvalues: np.ndarray    # falling
    vectors: np.ndarray        # unit columns

    @property
    def usable(self) -> np.ndarray:
        """Components with variance, beyond what rounding leaves of zero."""
        top = self.eigenvalues[0] if len(self.eigenvalues) else 0.0
        return self.eigenvalues > max(0.0, top) * self.dimension * np.finfo(float).eps

    def project(self, y: np.ndarray, components: int) -> np.ndarray:
        """Whitened values of centred rows; NaN for components without variance."""
        e, ok = self.eigenvalues[:components], self.usable[:components]
        away = y.astype(float) - np.asarray([s / self.n for s in self.sums])
        scale = np.divide(1.0, np.sqrt(e, where=ok, out=np.ones_like(e)), where=ok, out=np.full_like(e, np.nan))
        return (away @ self.vectors[:, :components]) * scale

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n * x - S) ^ 2``, exactly."""
        bound = self.n * _largest(y) + max((abs(s) for s in self.sums), default=0)
        z = _exact(y, self.dimension * bound * bound)
        s = np.asarray(self.sums, z.dtype)
        z = z * self.n - s
        return [int(v) for v in (z * z).sum(axis=1)]


def fit(rows: DataFrame) -> Whitening | None:
    """Fit on all ``usable_rows`` of the commonest length (of equally common
    ones the longest); None without rows."""
    top = (rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first())
    if top is None:
        return None
    d, n = top["d"], top["count"]
    rows = rows.where(F.size("x") == d)
    total = _sums(rows, d, d, _dimension_sums)
    pivot = [(2 * s + n) // (2 * n) for s in total]
    squares = _sums(rows, d, d * (d + 1) // 2, lambda x: pair_squares(centre(x, pivot)))
    sums = [s - n * p for s, p in zip(total, pivot)]
    v = covariances(n, sums, squares, d)
    e, u = np.linalg.eigh(v)
    return Whitening(d, n, pivot, sums, v, e[::-1].copy(), np.ascontiguousarray(u[:, ::-1]))


def identity_error(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the
    identity, over the components that have variance: measured on all rows."""
    k, d = min(components, model.dimension), model.dimension

    def partial(batches) -> Iterator:
        import pyarrow as pa
        gram = np.zeros((k, k))
        for b in batches:
            w = np.nan_to_num(model.project(centre(_matrix(b.column(0), d), model.pivot), k))
            gram += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(gram.ravel())], names=["k", "s"])

    ok, gram = model.usable[:k], np.zeros(k * k)
    for r in (rows.where(F.size("x") == d).select("x").mapInArrow(partial, "k int, s double")
              .groupBy("k").agg(F.sum("s").alias("s")).collect()):
        gram[r["k"]] = r["s"]
    off = (np.abs(gram.reshape(k, k) / model.n - np.eye(k)))[np.ix_(ok, ok)]
    return float(off.max()) if off.size else None


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """One row per usable vector and component (the first ``components``):
    ``vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_digits``.

    Vectors that are null, empty, or hold null, non-finite or 2^56-sized
    entries take no part; neither do those of another length than the
    commonest, whose missing or extra entries have no counterpart. Repeated
    rows, equal ids and null ids each count and come out as rows of their own;
    other columns are left out. A component without variance has ``explained``
    0 and a null ``whitened``; without any variance ``explained`` and
    ``identity_error`` are null. ``deviation`` is null where it exceeds a long,
    ``deviation_digits`` always has it. No usable vector gives no rows."""
    prepare(vectors.sparkSession)
    rows = usable_rows(vectors, id_col, column)
    model = fit(rows)
    schema = "vec_id long, deviation long, deviation_digits string, whitened array<double>"
    if model is None:
        rows, d, k, error, shares, n = rows.limit(0), 1, 1, None, [None], 0
    else:
        d, k, n = model.dimension, min(components, model.dimension), model.n
        error, trace = identity_error(rows, model, k), float(np.trace(model.covariance))
        shares = [max(0.0, float(e)) / trace if trace > 0 else None for e in model.eigenvalues[:k]]

    def project(batches) -> Iterator:
        import pyarrow as pa
        for b in batches:
            y = centre(_matrix(b.column(1), d), model.pivot)
            w, far = model.project(y, k), model.deviations(y)
            at = pa.array(np.arange(len(y) + 1, dtype=np.int32) * k)
            values = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f if f < 1 << 63 else None for f in far], pa.int64()),
                 pa.array([str(f) for f in far]), pa.ListArray.from_arrays(at, values)],
                names=["vec_id", "deviation", "deviation_digits", "whitened"])

    out = rows.where(F.size("x") == d).mapInArrow(project, schema)
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    return (out.select("vec_id", "deviation", "deviation_digits", F.posexplode("whitened").alias("_p", "whitened"))
            .select("vec_id", (F.col("_p") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(explained, F.col("_p")).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error"), "deviation_digits"))
