"""T5 triage (fixture F6), U8 request dedup, N4/N5 walk with cycles."""

import datetime as dt

from quire.operators import frontier as fr

T0 = dt.datetime(2024, 1, 1)


def test_triage(spark):
    rows = [("a", 200, None), ("b", 304, None), ("c", 404, None), ("d", 429, "12"), ("e", 503, None),
            ("f", 429, "Wed, 21 Oct 2015 07:28:00 GMT")]
    df = spark.createDataFrame([(u, s, r, T0) for u, s, r in rows],
                               "url string, status int, retry_after string, received_at timestamp")
    got = {r.url: (r.action, r.delay_s, r.next_attempt_at) for r in fr.triage(df).collect()}
    assert got["a"] == ("accept", None, None) and got["c"] == ("accept", None, None)
    assert got["b"] == ("drop", None, None)
    assert got["d"] == ("retry", 12, T0 + dt.timedelta(seconds=12))
    assert got["e"][1] == 30 and got["f"][1] == 30
    assert sorted(r.url for r in fr.cacheable(df).collect()) == ["a", "b", "c"]


def test_dedup_requests(spark):
    df = spark.createDataFrame([("u", 5, "late"), ("u", 1, "early"), ("v", 2, "only")], "url string, seq long, tag string")
    assert {r.url: r.tag for r in fr.dedup_requests(df).collect()} == {"u": "early", "v": "only"}


def test_walk_cycles_and_depth(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (1, 4), (4, 5), (9, 10)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    got = {r.node: r.depth for r in fr.walk(seeds, edges).collect()}
    assert got == {1: 0, 2: 1, 4: 1, 3: 2, 5: 2}


def test_walk_has_no_bound_and_folds(spark, monkeypatch):
    from quire.operators import frontier as fr

    monkeypatch.setattr(fr, "FOLD_PIECES", 3)
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(14)] + [("n5", "n2"), ("n3", None), (None, "n1")], "src string, dst string")
    got = {r.node: r.depth for r in fr.walk(spark.createDataFrame([("n0",)], "node string"), edges).collect()}
    assert got == {f"n{i}": i for i in range(15)}


def test_chain_of_pages_in_few_steps(spark, monkeypatch):
    """100,000 pages behind each other: fewer than 20 doublings, true depths; cycles and meeting chains end."""
    n = 100_000
    steps = []
    cut = fr.cut_lineage
    monkeypatch.setattr(fr, "cut_lineage", lambda df: steps.append(1) or cut(df))
    edges = spark.range(n - 1).selectExpr("id AS src", "id + 1 AS dst")
    out = fr.walk(spark.createDataFrame([(0,)], "node long"), edges)
    assert out.where("node <> depth").count() == 0 and out.count() == n
    assert (len(steps) - 2) / 2 < 20
    rows = [(1, 2), (2, 3), (3, 1), (7, 3), (8, 7), (9, 9), (20, 21), (None, 1), (21, None)]
    got = {r.node: r.depth for r in fr.walk(spark.createDataFrame([(1,), (8,), (9,), (None,)], "node long"),
                                            spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 8: 0, 7: 1, 9: 0}
