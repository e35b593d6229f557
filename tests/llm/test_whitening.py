"""Exact whitening against plain numpy, and its steps against exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, component string, n string, v string"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in enumerate(vectors)], schema).repartition(3)


def determinant_polynomial(m):
    """Faddeev-LeVerrier, exact."""
    d = len(m)
    a, out, b = np.array(m, object), [1], np.zeros((d, d), object)
    for k in range(1, d + 1):
        b = a.dot(b) + out[-1] * np.eye(d, dtype=int).astype(object)
        out.append(-Fraction(int(a.dot(b).trace()), k))
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("seed,d,rank", [(0, 1, 1), (1, 2, 2), (2, 7, 7), (3, 9, 4), (4, 12, 12)])
def test_characteristic_polynomial(spark, seed, d, rank):
    x = np.random.default_rng(seed).integers(-50, 50, (rank, d))
    m = (x.T @ x).tolist()
    assert W.characteristic_polynomial(spark, m) == determinant_polynomial(m)


def test_roots_with_multiplicity():
    poly = [1]
    for r in (0, 0, 3, 3, 3, 10, 12):
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    unit = 1 << W.FRACTION
    assert W.largest_roots(poly, 9) == [(12 * unit, 1), (10 * unit, 1), (3 * unit, 3)]
    assert W.largest_roots(poly, 1) == [(12 * unit, 1)]
    root = W.largest_roots([-2, 0, 1][:0] or [1, -3, 1], 1)[0][0]
    assert abs(root / unit - (3 + math.sqrt(5)) / 2) < 1e-15


def check(rows, vectors, count=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float))
    e, u = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    e, u = e[::-1], u[:, ::-1]
    k = min(count, x.shape[1])
    w = np.zeros((len(x), k))
    n = len(x)
    s = [int(v) for v in x.sum(axis=0)]
    for r in rows:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        assert r["deviation"] == sum((n * int(a) - b) ** 2 for a, b in zip(x[r["vec_id"]], s, strict=True))
    want = (x - x.mean(axis=0)) @ u[:, :k] / np.sqrt(e[:k])
    want *= np.sign((want * w).sum(axis=0))
    assert len(rows) == n * k and np.abs(want - w).max() < 1e-7


@pytest.mark.parametrize("n,d,count", [(200, 8, 32), (90, 40, 32), (50, 3, 2)])
def test_against_numpy(spark, n, d, count):
    rng = np.random.default_rng(n)
    vectors = (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 5).astype(np.float32).tolist()
    check(W.whitened(table(spark, vectors), count=count).collect(), vectors, count)


def test_equal_eigenvalues(spark):
    """A cross has a covariance with one eigenvalue in all directions."""
    vectors = [[float(s * (i == j)) for j in range(4)] for i in range(4) for s in (1, -1)]
    rows = W.whitened(table(spark, vectors)).collect()
    w = np.zeros((8, 4))
    for r in rows:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["explained"] == 0.25 and r["identity_error"] < 1e-12
    assert len(rows) == 32 and np.abs(w.T @ w / 8 - np.eye(4)).max() < 1e-12


def test_close_eigenvalues():
    """Eigenvalues a ten-billionth apart still give separate components."""
    m = [[10 ** 20, 1, 0], [1, 10 ** 20 + 1, 0], [0, 0, 7]]
    (a, _), (b, _), (c, _) = roots = W.largest_roots(determinant_polynomial(m), 3)
    assert [k for _, k in roots] == [1, 1, 1] and Fraction(c, 1 << W.FRACTION) == 7
    unit = (1 + math.sqrt(5)) / 2
    v = W.null_vectors(m, a, 1)[0]
    assert v[1] / v[0] == pytest.approx(unit, rel=1e-14) and abs(v[2]) < 1e-99
    assert sum(x * y for x, y in zip(v, W.null_vectors(m, b, 1)[0], strict=True)) == pytest.approx(0, abs=1e-15)


def test_left_out_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [0.5, 0.25]]
    rows = [(i, v, "a", "b", "c") for i, v in enumerate([*good, None, [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], []])]
    got = W.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, good)
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None]):
        out = W.whitened(table(spark, vectors))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [2.0, 2.0])], "vec_id long, embedding array<double>")
    got = W.whitened(df).collect()
    assert len(got) == 6 and sum(r["vec_id"] is None for r in got) == 2 and all(r["identity_error"] < 1e-12 for r in got)


def test_large_entries(spark):
    """Sums beyond 64 bits stay exact; a deviation that fits no long is null."""
    df = spark.createDataFrame([(0, [1e15, 3.0]), (1, [-1e15, 4.0]), (2, [1e300, 5.0])], "vec_id long, embedding array<double>")
    n, s, m = W.scatter(W.finite_vectors(df, "vec_id", "embedding"), 2)
    x = [[64 * 10 ** 15, 192], [-64 * 10 ** 15, 256], [1 << 62, 320]]
    assert n == 3 and s == [sum(c) for c in zip(*x, strict=True)]
    assert m == [[3 * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(2)] for i in range(2)]
    got = W.whitened(df).collect()
    assert len(got) == 6 and all(r["deviation"] is None and math.isfinite(r["whitened"]) for r in got)
