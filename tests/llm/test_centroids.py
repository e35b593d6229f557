"""Incremental k-means against plain exact k-means."""

import hashlib
import math
import random

import pytest

from quire.llm import centroids as K

SCHEMA = "vec_id long, embedding array<double>, cluster string, x string, dots string"


def brute(rows, dim, clusters, rounds):
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    centres = [list(x) for _, x in sorted([r for r in kept if r[0] is not None], key=key)[:clusters]]

    def assign():
        out = []
        for i, x in kept:
            d, k = min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centres))
            out.append((i, x, k, d))
        return out

    for _ in range(rounds):
        got = assign()
        for k in range(len(centres)):
            mine = [x for _, x, j, _ in got if j == k]
            if mine:
                centres[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    got = assign()
    inertia = [sum(d for *_, j, d in got if j == k) for k in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, k, d, inertia[k], sum(inertia), names[k]) for i, _, k, d in got)


@pytest.mark.parametrize("n,dim,clusters,rounds", [(200, 64, 8, 10), (60, 3, 5, 4), (4, 2, 8, 3), (300, 2, 8, 10)])
def test_against_plain(spark, n, dim, clusters, rounds):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(i % 5, 0.4) for _ in range(dim)]) for i in range(n)]
    rows += [(1000 + i, [round(c) / 2 for c in rows[i % n][1]]) for i in range(n // 3)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    got = K.clustered(df, dim=dim, clusters=clusters, rounds=rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows, dim, clusters, rounds)


def test_dots_move_by_changed_components_only(spark):
    """The dot products after a step are those of the new centroids."""
    rows = K.kept_vectors(spark.createDataFrame([(i, [i / 8, -i / 4, 1.0]) for i in range(20)], "vec_id long, embedding array<double>"),
                          "vec_id", "embedding", 3, 1024)
    one = [[100, 200, 300], [0, 0, 0]]
    two = [[100, 250, 300], [0, 0, 0]]
    first = K._step(rows.select("vec_id", "x"), [], one, 3).where("sums IS NULL")
    second = K._step(first, one, two, 3).where("sums IS NULL").collect()
    again = K._step(rows.select("vec_id", "x"), [], two, 3).where("sums IS NULL").collect()
    assert sorted((r["vec_id"], bytes(r["dots"]), r["cluster"], r["distance"]) for r in second) == \
        sorted((r["vec_id"], bytes(r["dots"]), r["cluster"], r["distance"]) for r in again)


def test_left_out_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, [None, 0.0]), (6, [1.0]), (7, [5.0, 5.0]), (7, [5.5, 5.0])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    assert sorted(map(tuple, K.clustered(df, dim=2, clusters=2, rounds=3).collect())) == brute(rows, 2, 2, 3)
    for few in ([], [(1, None)]):
        out = K.clustered(spark.createDataFrame([(*r, "a", "b", "c") for r in few], SCHEMA), dim=2)
        assert out.collect() == [] and "centroid_sha256" in out.columns
    wide = K.clustered(spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 1.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>"), dim=2)
    got = {r["vec_id"]: r for r in wide.collect()}
    assert got[1]["cluster"] is None and got[2]["distance"] == got[None]["distance"] == 512 ** 2


def test_empty_cluster_stays(spark):
    """Two equal starting vectors: the second cluster never gets a row."""
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(i, [1.0, float(i)]) for i in range(6, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, K.clustered(df, dim=2, clusters=8, rounds=10).collect())) == brute(rows, 2, 8, 10)
