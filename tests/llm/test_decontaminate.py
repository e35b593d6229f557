"""Containment against brute force."""

import random

import pytest

from quire.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id long, containment string"
ITEMS = "item_id long, text string, doc_id int"


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def holds(text, item, percent):
    w, words = (item or "").split(), shingles(item)
    if not words:
        return None
    have = shingles(text, min(5, len(w))) if len((text or "").split()) >= min(5, len(w)) else set()
    n = len(words & have)
    return (len(words), n) if 100 * n >= percent * len(words) else None


def brute(docs, items, percent=80):
    out = {}
    for d, t, *_ in docs:
        for i, x, _ in items:
            if hit := holds(t, x, percent):
                out[d, i] = max(out.get((d, i), (0, 0)), hit[::-1])
    return {(*k, v[1], v[0]) for k, v in out.items()}


def data():
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([5, 7, 14, 30, 59, 90, 140])), 0) for i in range(30)]
    items += [(40, "Only THREE words", 0), (41, None, 0), (42, " ", 0), (43, "word", 0), (None, text(20), 0)]
    docs = []
    for d in range(60):
        body = text(rng.choice([3, 40, 400, 6000])).split()
        for _ in range(rng.randint(0, 3)):
            piece = (rng.choice(items)[1] or "").split()
            k = int(len(piece) * rng.choice([0.5, 0.8, 0.9, 1, 1]))
            at = rng.randint(0, len(body))
            body[at:at] = piece[:k]
        docs.append((d, " ".join(body), 1, "x"))
    whole = [t for _, t, _ in items[:8]]
    halves = " ".join(w for t in whole for w in [t[:len(t) // 2], text(50), t[len(t) // 2:]])
    docs += [(70, halves, 1, "x"), (71, None, 1, "x"), (72, "", 1, "x"), (73, "a word only three words", 1, "x"), (None, whole[0], 1, "x"),
             (74, "word", 1, "x"), (5, docs[5][1], 1, "x")]
    return docs, items


@pytest.mark.parametrize("block", [2_000_000, 900])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_SHINGLES", block)
    docs, items = data()
    got = dc.contained_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    rows = [(r["doc_id"], r["item_id"], r["n_item"], r["n_found"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(docs, items)


def test_size_partitions_find_scattered_items():
    rng = random.Random(8)
    vocab = [f"q{i}" for i in range(5000)]
    item = [rng.choice(vocab) for _ in range(48)]
    index = dc.ItemIndex([(1, " ".join(item))], 5)
    for _ in range(50):
        noise = [[rng.choice(vocab) for _ in range(rng.randint(200, 4000))] for _ in range(3)]
        body = noise[0] + item[:24] + noise[1] + item[20:] + noise[2]
        assert index.contained(" ".join(body), 80) == [(1, 44, 44)]


def test_drop(spark):
    docs, items = data()
    df = spark.createDataFrame(docs, DOCS)
    out = dc.drop_contaminated(df, spark.createDataFrame(items, ITEMS))
    bad = {d for d, *_ in brute(docs, items)} - {None}
    assert out.columns == df.columns
    assert sorted(map(str, (r["doc_id"] for r in out.collect()))) == sorted(str(d) for d, *_ in docs if d not in bad)
    none = spark.createDataFrame([], ITEMS)
    assert dc.contained_items(df, none).count() == 0 and dc.contained_items(df.limit(0), none).count() == 0
