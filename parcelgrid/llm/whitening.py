"""Embedding whitening with eigenvectors by mixed-precision refinement.

Components are taken as the integers floor(scale * c). The covariance is exact:
vectors are centred at their integer mean before they are multiplied, tasks sum
integer products, the sums meet as decimals, and the part of the mean that the
integers leave out is taken off as a fraction. Each entry is then rounded once.

The matrix of d x d numbers is solved on the driver, whatever the number of
rows. Eigenvectors come from a float32 solver and are corrected by Ogita-Aishima
iterations, which are matrix products in extended precision: each turns an error
e into one of the order e * e. Between eigenvalues that lie too close for that,
the iteration only restores orthogonality; such a cluster is solved on its own
afterwards, by the small matrix that its vectors span, shifted by its mean, and
the iterations go on from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.llm.scratch import Kept

SCALE = 256
COMPONENTS = 4
#: Iterations of one run, and runs between which clusters are solved on their own.
ITERATIONS, RUNS = 10, 4
#: Components whose integers would lie beyond this have no exact long and count as not finite.
LARGEST = 1 << 62
#: Sums travel as two decimals, high and low, so that no product of longs is too large.
LIMB = 60
EXACT = 1 << 53


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, x, d``: components as longs floor(scale * c), of the vectors that are finite throughout, and their number."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float(LARGEST // scale)))
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x")
    return rows.filter(F.col("v").isNotNull() & whole).select("id", x, F.size("v").alias("d"))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact sums of products of the columns of ``y``, as Python integers."""
    largest = int(np.abs(y).max(initial=0))
    rows = EXACT // max(1, largest * largest)
    if not rows:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1],) * 2, object)
    for start in range(0, len(y), rows):
        # doubles hold every partial sum exactly
        part = y[start : start + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, int]:
    """The sum over all rows of ``of(matrix)``, an array of integers, by flat position."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            own = of(matrix(batch)).ravel()
            total = own if total is None else total + own
        if total is not None:
            high = [int(v) >> LIMB for v in total]
            low = [int(v) - (h << LIMB) for v, h in zip(total, high)]
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(high, wide), pa.array(low, wide)], ["at", "high", "low"]
            )

    parts = fit.select("x").mapInArrow(find, "at int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {r["at"]: (int(r.high) << LIMB) + int(r.low) for r in rows}


@dataclass
class Fit:
    """Exact sums of the distinct vectors, and what whitens them."""

    n: int
    sums: list[int]
    middle: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: list[float]


def extended(value: Fraction) -> np.longdouble:
    """The nearest extended number, as a double and what it leaves."""
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble]:
    """Ogita-Aishima: eigenvalues, the correction E of x' = x + x E, and the gap below which values form a cluster."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    # symmetric, so that the rounding of close pairs turns them and no more
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: np.sqrt((m * m).sum())
    # rounding alone parts equal eigenvalues by the last term
    least = 2 * (norm(s - np.diag(values)) + norm(a) * norm(r)) + 32 * np.finfo(a.dtype).eps * norm(a)
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > least
    return values, np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2), least


def iterated(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Iterations until corrections no longer shrink."""
    before = np.inf
    for _ in range(ITERATIONS):
        _, e, _ = correction(a, x)
        size = np.abs(e).max(initial=0)
        x = x + x @ e
        if size < np.finfo(a.dtype).eps * 4 or (size < 1e-6 and size > before / 4):
            break
        before = size
    return x


def clusters(values: np.ndarray, least: np.longdouble) -> list[np.ndarray]:
    """Positions of the eigenvalues that follow each other by no more than ``least``, two or more at a time."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > least) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and the eigenvectors as columns, of a symmetric matrix of extended numbers."""
    top = np.abs(a).max(initial=0)
    scale = np.longdouble(2) ** int(np.frexp(top)[1]) if top > 0 else np.longdouble(1)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    x = iterated(a, x)
    for _ in range(RUNS):
        values, _, least = correction(a, x)
        close = clusters(values, least)
        for group in close:
            own = x[:, group]
            mean = values[group].mean()
            small = own.T @ (a @ own) - mean * (own.T @ own)
            size = np.abs(small).max()
            if size > 0:
                # relative to the cluster's width, a double is precise
                x[:, group] = own @ np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1]
        if not close:
            break
        x = iterated(a, x)
    values = np.diag(x.T @ (a @ x)) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return values[order] * scale, x * signs


def covariance(n: int, products: dict[int, int], rest: list[int], d: int) -> np.ndarray:
    """The covariance from sums of products about the integer mean, and the sums about it."""
    v = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = extended(Fraction(n * products[i * d + j] - rest[i] * rest[j], n * n))
    return v


def fitted(fit: DataFrame, d: int, components: int) -> Fit:
    """Two passes over the distinct vectors of ``d`` components: sums, then products about the integer mean."""

    def counted(x: np.ndarray) -> np.ndarray:
        # 32 bits at a time: no sum of a batch overflows
        halves = [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
        return np.append((halves[0].astype(object) << 32) + halves[1].astype(object), len(x))

    found = summed(fit, counted)
    n, sums = found[d], [found[i] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    middle = np.array(centre, np.int64)
    products = summed(fit, lambda x: gram(x - middle))
    rest = [s - n * m for s, m in zip(sums, centre)]
    v = covariance(n, products, rest, d)
    values, axes = eigen(v)
    trace = np.trace(v)
    k = min(components, d)
    zero = max(0, values[0]) * d * 2.0**-58
    values = np.where(values[:k] > zero, values[:k], 0).astype(np.float64)
    explained = [float(e / trace) if trace > 0 else None for e in values]
    return Fit(n, sums, middle, np.array([r / n for r in rest]), axes[:, :k].astype(np.float64), values, explained)


def deviations(x: np.ndarray, fit: Fit) -> pa.Array:
    """The sum over dimensions of (n * x - S) ** 2, exact; null beyond 38 digits."""
    most = fit.n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in fit.sums)
    if x.shape[1] * most * most < 1 << 63:
        off = fit.n * x - np.array(fit.sums, np.int64)
        return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
    off = x.astype(object) * fit.n - np.array(fit.sums, object)
    squares = (off * off).sum(axis=1)
    return pa.array([int(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))


def projected(rows: DataFrame, fit: Fit, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``rows``, ``deviation``, and the array ``whitened``, null where there is no variance."""
    good = fit.values > 0
    weights = np.where(good, fit.axes / np.sqrt(np.where(good, fit.values, 1)), 0)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch)
            w = ((x - fit.middle) - fit.rest) @ weights
            mask = np.broadcast_to(~good, w.shape).ravel()
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(good)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel(), mask=mask))
            own = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*own, deviations(x, fit), listed], [*keep, "deviation", "whitened"])

    added = [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    return rows.select(*keep, "x").mapInArrow(find, T.StructType([*(rows.schema[c] for c in keep), *added]))


def identity_error(fit_rows: DataFrame, fit: Fit) -> float | None:
    """How far the covariance of the whitened distinct vectors is from the identity; null without variance."""
    used = [i for i, e in enumerate(fit.values) if e > 0]
    if not used:
        return None
    w = projected(fit_rows, fit, [])
    pairs = [(i, j) for i in used for j in used if i <= j]
    # covar_pop takes the running means off before it multiplies
    found = w.agg(*(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: each vector along the first components.

    Vectors that are null or hold a null, non-finite or too large component
    (2**62 as an integer) are left out, as are those without components. The
    fit is over distinct integer vectors, so copies weigh nothing; repeated rows
    and null ids get rows all the same. Vectors of different lengths are fitted
    apart, each length with its own ``n``. ``deviation`` is a decimal, null
    beyond 38 digits. A component without variance has ``whitened`` null, and
    ``explained`` 0 (null if nothing varies). Equal eigenvalues come in any order. An empty
    table gives no rows, other columns are not looked at.
    """
    rows = quantised(vectors, id_col, vector_col, scale).filter("d > 0")
    fit_rows = Kept(rows.select("x", "d").distinct(), "fit").df
    parts = []
    # one round per length, not per row
    for (d,) in fit_rows.select("d").distinct().orderBy("d").collect():
        own = fit_rows.filter(F.col("d") == d)
        fit = fitted(own, d, components)
        error = identity_error(own, fit)
        each = projected(rows.filter(F.col("d") == d), fit, ["id"])
        explained = F.array(*(F.lit(e).cast("double") for e in fit.explained))
        parts.append(
            each.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
                F.col("id").alias(id_col),
                (F.col("at") + 1).alias("component"),
                F.lit(fit.n).cast("long").alias("n"),
                "deviation",
                "whitened",
                F.get(explained, F.col("at")).alias("explained"),
                F.lit(error).cast("double").alias("identity_error"),
            )
        )
    if not parts:
        key = rows.schema["id"].dataType.simpleString()
        empty = f"`{id_col}` {key}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)
