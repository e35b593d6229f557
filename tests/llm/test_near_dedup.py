"""Near-duplicates against brute force: all pairs, full sets, plain search."""

import itertools
import random

import pytest

from quire.llm import near_dedup as nd

SCHEMA = "doc_id long, text string, component_id long, bands string, node string"


def words(text):
    low = (text or "").encode().lower()
    return low.split()


def sets_of(text, width):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def brute(rows, width, percent):
    sets = {i: sets_of(t, width) for i, t in rows}
    comp = {i: i for i in sets}
    edges = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for i in range(n):
        kind = rng.random()
        if base and kind < 0.25:
            text = rng.choice(base)
        elif base and kind < 0.7:
            w = rng.choice(base[:3]).split()
            for _ in range(rng.randint(1, 7)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            text = " ".join(w)
        else:
            text = " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 60, 150])))
            base.append(text)
        rows.append((i, text))
    return rows


def run(spark, rows, width=4, percent=80):
    df = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows], SCHEMA)
    out = nd.near_duplicates(df, width=width, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("pivots,block", [(2, 256), (1, 5), (0, 3)])
def test_equals_brute_force(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(nd, "PIVOT_ROUNDS", pivots)
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = corpus(3, 120)
    assert {i: (n, c, k) for i, n, c, k in run(spark, rows)} == brute(rows, 4, 80)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " z"), (8, "É two"), (9, "é two")]
    got = {i: (n, c, k) for i, n, c, k in run(spark, rows)}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[5] == (1, 4, False) and got[7][1] == 6
    assert got[9] == (1, 9, True)          # only A-Z is folded
    # repeated rows, an id with two texts, null ids
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (None, "other text"), (None, None)]
    got = sorted(run(spark, rows), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (None, 1, None, True),
                          (None, 0, None, True)], key=str)
    assert run(spark, []) == []


def test_drop_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 7, "x", "y"), (2, "a b c d e f", 8, "p", "q"), (None, "z", 9, None, None)], SCHEMA)
    out = nd.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r["component_id"] for r in out.collect()) == [7, 9]


def test_signature_parts():
    import numpy as np

    rng = np.random.default_rng(0)
    low = rng.integers(0, 2 ** 32, nd.PERMS, dtype=np.uint32)
    other = low.copy()
    other[:40] ^= 1
    assert nd.equal_lanes(nd.pack(low), nd.pack(other)) == nd.PERMS - 40
    assert nd.corrected(nd.PERMS) == 1 and abs(nd.corrected(nd.PERMS / 16)) < 1e-9
