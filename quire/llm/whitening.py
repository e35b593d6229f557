"""Whitening from the exact characteristic polynomial of the scatter matrix.

Entries become integers, so the scatter ``M = n * sum(x x') - S S'`` (n^2 times
the covariance) is an integer matrix, summed exactly by Spark. Its
characteristic polynomial is taken modulo many primes, one Hessenberg
reduction each, spread over tasks, and put together by Chinese remaindering.
All its roots are real, so the sign variations of the polynomial moved to a
count the roots beyond a exactly; bisection isolates the largest roots and
signs refine them to ``FRACTION`` binary places. Each component is the null
space of ``M - root`` by inverse iteration in fixed-point integers, as many
vectors as the root counts for. The matrix is as wide as a vector, whatever
the number of rows.
"""

from __future__ import annotations

from fractions import Fraction
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
# Entries are held at this bound, so that they fit a long.
EDGE = float(1 << 62)
# Binary places of the roots, and of the fixed-point vectors.
FRACTION, PLACES = 64, 384
_LONG = (1 << 63) - 1


# --- exact sums ---------------------------------------------------------------

def finite_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors without null or non-finite entries."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    return table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(fine, v).alias("v")).where("v IS NOT NULL")


def _whole(column: pa.Array, rows: int, dim: int) -> np.ndarray:
    """floor(SCALE * entry) as int64; OFFSET, common to all, is left out."""
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, dim)
    return np.floor(np.clip(v * SCALE, -EDGE, EDGE)).astype(np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y, exact; Python integers where 64 bits might not do."""
    most = int(np.abs(y).max(initial=0)) ** 2 * max(1, len(y))
    if most < 1 << 53:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    y = y if most < _LONG else y.astype(object)
    return (y.T @ y).astype(object)


def scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums of (x - OFFSET) and the scatter matrix, exact. Every task
    sends out its own sums as two halves; Spark adds them as decimals."""
    upper = np.triu_indices(dim)

    def run(batches):
        n, s, g = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for b in batches:
            y = _whole(b.column("v"), b.num_rows, dim)
            n, s, g = n + len(y), s + y.astype(object).sum(axis=0), g + _products(y)
        flat = [n, *s, *g[upper]]
        kind, half = pa.decimal128(38, 0), (1 << 60) - 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array([int(v) >> 60 for v in flat], kind),
                                          pa.array([int(v) & half for v in flat], kind)], ["at", "hi", "lo"])

    parts = rows.select("v").mapInArrow(run, "at int, hi decimal(38,0), lo decimal(38,0)")
    got = {r["at"]: (int(r["hi"]) << 60) + int(r["lo"]) for r in parts.groupBy("at").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()}
    n, s = got.get(0, 0), [got.get(1 + i, 0) for i in range(dim)]
    m = [[0] * dim for _ in range(dim)]
    for at, (i, j) in enumerate(zip(*upper, strict=True), 1 + dim):
        m[i][j] = m[j][i] = n * got.get(at, 0) - s[i] * s[j]
    return n, s, m


# --- characteristic polynomial ------------------------------------------------

def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every n below 3.4e14."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product is over ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar upper Hessenberg matrix modulo p."""
    a, d = a % p, len(a)
    for m in range(1, d - 1):
        rows = np.flatnonzero(a[m:, m - 1])
        if not len(rows):
            continue
        k = m + int(rows[0])
        if k != m:
            a[[m, k]] = a[[k, m]]
            a[:, [m, k]] = a[:, [k, m]]
        u = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * u % p).sum(axis=1)) % p
    return a


def polynomial_mod(h: np.ndarray, p: int) -> np.ndarray:
    """det(t - h) modulo p of an upper Hessenberg matrix, lowest power first."""
    d = len(h)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        out = np.roll(polys[k], 1)
        weights, chain = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else 0
        polys[k + 1] = (out - (weights[:, None] * polys[:k + 1] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark, m: list[list[int]]) -> list[int]:
    """Coefficients of det(t - m), lowest power first, for a symmetric integer
    matrix without negative eigenvalues. The coefficients' absolute values add up to
    at most (1 + trace / d)^d, which bounds the number of primes."""
    d = len(m)
    bound = 2 * (2 + sum(m[i][i] for i in range(d)) // d) ** d
    primes = primes_beyond(bound)

    def run(batches):
        for pdf in batches:
            left = [polynomial_mod(hessenberg(np.array([[v % p for v in row] for row in m], np.int64), p), p).tolist() for p in pdf["p"].tolist()]
            yield pd.DataFrame({"p": pdf["p"], "left": left})

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    found = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInPandas(run, "p long, left array<long>").collect()
    product, total = 1, [0] * (d + 1)
    for p in primes:
        product *= p
    for r in found:
        rest = product // r["p"]
        unit = rest * pow(rest, -1, r["p"])
        total = [t + v * unit for t, v in zip(total, r["left"], strict=True)]
    return [t - product if 2 * t > product else t for t in (t % product for t in total)]


# --- roots --------------------------------------------------------------------

def _beyond(poly: list[int], a: int) -> int:
    """Roots over a, by multiplicity: sign variations of poly(t + a)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], a: int) -> int:
    v = 0
    for c in reversed(poly):
        v = v * a + c
    return (v > 0) - (v < 0)


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots (root in units of 2^-FRACTION,
    multiplicity), falling; roots closer than a unit count as one."""
    d = len(poly) - 1
    scaled = [c << (FRACTION * (d - j)) for j, c in enumerate(poly)]
    high = 1
    while _beyond(scaled, high):
        high <<= 8
    out, need = [], count
    open_ = [(0, high, _beyond(scaled, 0), 0)]
    while open_ and need > 0:
        low, high, above_low, above_high = open_.pop()
        held = above_low - above_high
        if not held:
            continue
        if held == 1 or high - low == 1:
            if held == 1:
                top = _sign(scaled, high)
                while top and high - low > 1:
                    mid = (low + high) // 2
                    s = _sign(scaled, mid)
                    low, high, top = (low, mid, s) if s in (0, top) else (mid, high, top)
            out.append((high, held))
            need -= held
            continue
        mid = (low + high) // 2
        above = _beyond(scaled, mid)
        open_ += [(low, mid, above_low, above), (mid, high, above, above_high)]
    return out


# --- components ---------------------------------------------------------------

def _unit(v: np.ndarray) -> np.ndarray:
    return np.array([(int(x) << PLACES) // max(1, isqrt(sum(int(y) ** 2 for y in v))) for x in v], object)


def null_vectors(m: list[list[int]], root: int, count: int, rounds: int = 3) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of m - root, by inverse
    iteration with one triangular factorisation in fixed-point integers."""
    d = len(m)
    scale = max(1, sum(m[i][i] for i in range(d)))
    a = np.array([[((v << FRACTION) - (root if i == j else 0)) * (1 << PLACES) // (scale << FRACTION) for j, v in enumerate(row)]
                  for i, row in enumerate(m)], object)
    order, lower = np.arange(d), np.zeros((d, d), object)
    for k in range(d):
        at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        for x in (a, lower, order):
            x[[k, at]] = x[[at, k]]
        a[k, k] = a[k, k] or 1
        u = np.array([(v << PLACES) // a[k, k] for v in a[k + 1:, k]], object)
        lower[k + 1:, k] = u
        if len(u):
            a[k + 1:, k:] -= (u[:, None] * a[k, k:]) >> PLACES

    def solved(b):
        y = b[order].copy()
        for k in range(d):
            y[k + 1:] -= (lower[k + 1:, k] * y[k]) >> PLACES
        for k in range(d - 1, -1, -1):
            y[k] = (int(y[k]) << PLACES) // a[k, k]
            y[:k] -= (a[:k, k] * y[k]) >> PLACES
        return y

    one = 1 << PLACES
    start = np.random.default_rng(d).integers(1, 1 << 30, (count, d))
    vectors = [np.array([int(x) * one >> 30 for x in row], object) for row in start]
    for _ in range(rounds):
        vectors = [_unit(solved(v)) for v in vectors]
        for i, v in enumerate(vectors):
            for w in vectors[:i] * 2:
                v = v - ((w * (int((v * w).sum()) >> PLACES)) >> PLACES)
            vectors[i] = _unit(v)
    out = []
    for v in vectors:
        lead = v[max(range(d), key=lambda i: abs(v[i]))]
        out.append([float(Fraction(int(x if lead > 0 else -x), one)) for x in v])
    return out


def components(spark, m: list[list[int]], count: int) -> list[tuple[Fraction, list[float]]]:
    """(eigenvalue, unit eigenvector) of m for the ``count`` largest positive
    eigenvalues; roots are spread over tasks."""
    roots = largest_roots(characteristic_polynomial(spark, m), count)
    if not roots:
        return []

    def run(batches):
        for pdf in batches:
            found = [[x for v in null_vectors(m, int(r), int(k)) for x in v] for r, k in zip(pdf["root"], pdf["held"], strict=True)]
            yield pd.DataFrame({"at": pdf["at"], "v": found})

    rows = spark.createDataFrame([(i, str(r), k) for i, (r, k) in enumerate(roots)], "at int, root string, held int")
    tasks = max(1, min(len(roots), spark.sparkContext.defaultParallelism))
    got = {r["at"]: np.array(r["v"]).reshape(-1, len(m)).tolist() for r in rows.repartition(tasks).mapInPandas(run, "at int, v array<double>").collect()}
    return [(Fraction(r, 1 << FRACTION), v) for i, (r, _) in enumerate(roots) for v in got[i]][:count]


def _root(value: Fraction) -> float:
    """Square root as a double, exact to the last place."""
    return float(Fraction(isqrt((value.numerator << 256) // value.denominator), 1 << 128))


# --- whitening ----------------------------------------------------------------

def _deviations(y: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - S, exact."""
    most = n * (int(np.abs(y).max(initial=0)) + 1) + max(map(abs, s), default=0)
    return n * (y if most < _LONG else y.astype(object)) - np.array(s, np.int64 if most < _LONG else object)


def _squares(dev: np.ndarray) -> pa.Array:
    """Sum of squares of every row as a long; null where a long is too short."""
    most = int(np.abs(dev).max(initial=0)) ** 2 * max(1, dev.shape[1])
    if most < _LONG:
        return pa.array((dev.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    total = (dev.astype(object) ** 2).sum(axis=1)
    return pa.array([int(t) if t <= _LONG else None for t in total], pa.int64())


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error:
    ``count`` rows per vector, fewer where the covariance has a lower rank.

    Vectors that are null or hold a null, NaN or infinite entry are left out.
    Where lengths differ, the commonest one counts (of equals the longest) and
    vectors of other lengths are left out. Entries beyond 2^56 are held there;
    a deviation that does not fit a long is null. Components of zero variance
    do not exist, so a table of equal vectors, one row or none gives no rows.
    Repeated rows and ids, and rows without id, count like all others. Other
    columns are not read.
    """
    spark = table.sparkSession
    C.prepare(spark)
    rows = finite_vectors(table, id_col, vector_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    most = rows.groupBy(F.size("v").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).head()
    if most is None:
        return spark.createDataFrame([], schema)
    dim = most["d"]
    rows = rows.where(F.size("v") == dim)
    n, s, m = scatter(rows, dim)
    found = components(spark, m, count)
    if not found:
        return spark.createDataFrame([], schema)
    k, trace = len(found), sum(m[i][i] for i in range(dim))
    basis = np.array([[x / _root(e) for x in v] for e, v in found]).T
    explained = np.array([float(e / trace) for e, _ in found])

    def projected(dev):
        return dev.astype(float) @ basis

    def sums(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = projected(_deviations(_whole(b.column("v"), b.num_rows, dim), n, s))
            first, second = first + w.sum(axis=0), second + w.T @ w
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "v"])

    parts = rows.select("v").mapInArrow(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    flat = np.array([r["v"] for r in parts]) / n
    error = float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())

    def run(batches):
        for b in batches:
            dev = _deviations(_whole(b.column("v"), b.num_rows, dim), n, s)
            r = len(dev)
            at = pa.array(np.repeat(np.arange(r), k))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)), pa.array(np.full(r * k, n, np.int64)),
                 _squares(dev).take(at), pa.array(projected(dev).ravel()), pa.array(np.tile(explained, r)), pa.array(np.full(r * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
