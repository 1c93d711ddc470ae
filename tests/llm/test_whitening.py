import math
import random
from fractions import Fraction

import numpy as np
import pytest

from parcelgrid.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    """Integer vectors by id, n, exact sums, and the exact covariance."""
    whole = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in whole]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    off = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    cov = [[Fraction(sum(r[i] * r[j] for r in off), n**3) for j in range(d)] for i in range(d)]
    return xs, fit, n, sums, np.array(cov, dtype=object).astype(np.float64)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    axes = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(5)]
    out = []
    for i in range(400):
        f = [rng.gauss(0, 1) * s for s in (3, 2, 1.5, 1, 0.2)]
        out.append((i, [sum(a[k] * g for a, g in zip(axes, f)) + 0.5 + rng.gauss(0, 0.05) for k in range(12)]))
    out += [(400 + i, out[7][1]) for i in range(150)] + [(3, out[3][1])]
    out += [(900, None), (901, [None] + [0.0] * 11), (902, [math.nan] + [0.0] * 11), (903, [math.inf] * 12), (None, out[0][1])]
    return out


def test_against_exact_covariance(spark, rows):
    xs, fit, n, sums, cov = plain(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = W.whiten(df).collect()
    assert len(got) == 4 * len(xs)
    want = {}
    for i, x in xs:
        y = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums)])
        want[i] = (sum((n * a - s) ** 2 for a, s in zip(x, sums)), y @ vectors[:, :4] / np.sqrt(values[:4]))
    signs = {}
    for r in got:
        deviation, w = want[r.vec_id]
        k = r.component - 1
        assert r.n == n and r.deviation == deviation
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-12)
        assert r.identity_error < 1e-11
        assert abs(r.whitened) == pytest.approx(abs(w[k]), rel=1e-9, abs=1e-11)
        if abs(w[k]) > 1e-6:
            signs.setdefault(k, set()).add(math.copysign(1, r.whitened * w[k]))
    assert all(len(s) == 1 for s in signs.values())
    more = df.selectExpr("*", "'x' AS x", "1 AS d", "2 AS id", "3 AS n", "4 AS whitened")
    key = lambda r: (r.vec_id is None, r.vec_id or 0, r.component)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, W.whiten(more).collect()), key=repr) and key


def test_edge_cases(spark):
    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in one)
    line = W.whiten(spark.createDataFrame([(1, [1.0, 5.0]), (2, [2.0, 5.0])], SCHEMA)).collect()
    assert sorted((r.component, r.whitened and abs(r.whitened)) for r in line) == [(1, 1.0), (1, 1.0), (2, None), (2, None)]
    both = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 1.0])], SCHEMA)
    found = W.whiten(both).collect()
    assert {(r.vec_id, r.n) for r in found} == {(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)}


def test_large_and_far_off_values(spark):
    """Sums beyond 64 bits, and a mean that is huge beside the spread."""
    wide = [(i, [1e15 * (i % 7) + i, -2e15 + 3.0 * i * i, 1.0 * i]) for i in range(50)]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    xs = sorted({tuple(math.floor(256 * c) for c in v) for _, v in wide})
    sums = [sum(x[k] for x in xs) for k in range(3)]
    got = {(r.vec_id, r.component): r for r in W.whiten(df).collect()}
    for i, v in wide:
        exact = sum((50 * math.floor(256 * c) - s) ** 2 for c, s in zip(v, sums))
        assert got[i, 1].deviation == (exact if exact < 10**38 else None)
    assert got[0, 1].identity_error < 1e-6


def close_to_eigen(a):
    values, x = W.eigen(a)
    eps = np.longdouble(1e-17)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 50 * eps
    assert np.abs(a @ x - x * values).max() <= 500 * eps * np.abs(a).max()
    assert (np.diff(values) <= 0).all()
    return values, x


def test_clusters_are_resolved_beyond_float32():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0].astype(np.longdouble)
    q = q @ (1.5 * np.eye(30) - 0.5 * (q.T @ q))  # orthonormal in extended precision
    q = q @ (1.5 * np.eye(30) - 0.5 * (q.T @ q))
    spread = np.longdouble(1) + np.arange(5, dtype=np.longdouble) * np.longdouble(1e-9)
    values = np.concatenate([[4, 3], spread, [0.5, 0.5, 0.5], np.linspace(0.4, 0.1, 20).astype(np.longdouble)]).astype(np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = close_to_eigen(a)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-16
    # each vector of the tight cluster, not only their space
    for value, k in zip(values[2:7], range(2, 7)):
        at = int(np.abs(found - value).argmin())
        assert abs(abs(q[:, k] @ x[:, at]) - 1) < 1e-14


def test_identity_diagonal_and_tiny_matrices():
    for a in (np.eye(6), np.diag([1.0, 1.0, 2.0]), np.zeros((3, 3)), np.array([[5.0]]), np.diag([1e40, 1.0, 1e-30])):
        close_to_eigen(a.astype(np.longdouble))
