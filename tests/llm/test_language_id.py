"""Gradients, the fast reader, held-out accuracy, defined results."""

import zlib

import numpy as np
import pytest

from quire.llm import language_id as li


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    w = {k: a.astype(np.float64) for k, a in li.new_weights(3, rng).items()}
    ids, labels = rng.integers(0, 256, (7, 3)), rng.integers(0, 3, 3)
    _, g = li.gradients(w, ids, labels)
    for k in w:
        for _ in range(4):
            at = tuple(int(rng.integers(0, n)) for n in w[k].shape)
            at = (int(ids[2, 1]), at[1]) if k[0] == "x" else at
            old, e = w[k][at], 1e-5
            w[k][at] = old + e
            up = li.gradients(w, ids, labels)[0]
            w[k][at] = old - e
            down = li.gradients(w, ids, labels)[0]
            w[k][at] = old
            assert abs(g[k][at] - (up - down) / (2 * e)) < 1e-7


def test_reader_equals_plain_network():
    """Padding, grouping by length and folded weights change nothing."""
    w = li.new_weights(3, np.random.default_rng(1))
    texts = ["a", "hello wörld", "x" * 255, "y" * 256, "z é" * 300, "q" * 1000]
    got = li.Reader(["a", "b", "c"], w).read(texts)
    for text, row in zip(texts, got, strict=True):
        raw, total = np.frombuffer(text.encode(), np.uint8), np.zeros(3)
        for i in range(0, len(raw), li.SEQUENCE):
            ids = raw[i:i + li.SEQUENCE].astype(int)[:, None]
            f, b = li._forward(w, "f", ids)[0], li._forward(w, "b", ids[::-1])[0][::-1]
            logits = np.concatenate((f, b), axis=2) @ w["o"] + w["b"]
            p = np.exp(logits - logits.max(axis=2, keepdims=True))
            total += (p / p.sum(axis=2, keepdims=True)).sum(axis=(0, 1))
        assert np.allclose(row, total / len(raw), atol=1e-4) and abs(row.sum() - 1) < 1e-4


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "12 %% 34", "de"), (None, "the thing and that", "xx"), (-4, "x", None)], docs.schema)
    docs = docs.union(odd).union(docs.where("doc_id = 5")).selectExpr("*", "1 AS score", "'z' AS held_out")
    return docs.collect(), li.predicted(docs, steps=150).collect()


def test_held_out_accuracy(judged):
    rows, got = judged
    assert len(rows) == len(got)
    lang = {r["doc_id"]: r["lang"] for r in rows}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    out = [r for r in got if r["held_out"] and r["doc_id"] >= 0]
    assert len(out) > 200 and np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in out]) > 0.98


def test_defined_results(judged):
    _, got = judged
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (-1, -2, -3))
    learned = {"en", "de", "es", "fr"}
    assert by[None]["lang_pred"] in learned and by[-4]["lang_pred"] in learned     # a label without id is not learnt
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 5}) == 1


def test_nothing_labelled(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in li.predicted(df).collect()} == {("und", 0.0)}
    assert li.predicted(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "some text", "en"), (3, "more", None)], df.schema)
    assert {r["lang_pred"] for r in li.predicted(one).collect()} == {"en"}
