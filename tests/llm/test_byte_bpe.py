"""Matrix merges against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest

from quire.llm import byte_bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def both():
    path = P.path(byte_bpe.VOCAB)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return byte_bpe.load(path, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    out = ["", None, "a" * 1000, "  \n\n " * 300, "x\x1cy \x1d z", "don't we'll", "ab" * 700, "\x00\x01" * 400, "é漢字😀" * 200, " ", "\r\n"]
    out += ["".join(rng.choice("abcdefgh  \n's.,é漢1") for _ in range(rng.randint(1, 900))) for _ in range(120)]
    return out + ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(200, 3000))) for _ in range(20)]


def test_equals_library(both):
    own, lib = both
    for text, ids in zip(texts(), own.encode(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(text or "")
        assert own.decode(ids) == (text or "").encode()


def test_long_piece_follows_the_same_rule(both):
    own, _ = both
    rng = random.Random(4)
    for _ in range(20):
        piece = bytes(rng.choice(b"abcdeimnorst") for _ in range(rng.randint(2, 200)))
        assert own.merge_long(piece).astype("<u4").tobytes() == own.merge_rows([piece], 256)[0]


def test_cache_limit_keeps_results(both, monkeypatch):
    own, lib = both
    monkeypatch.setattr(own.known, "limit", 10)
    monkeypatch.setattr(byte_bpe, "TEXT_CHARS", 50)
    sample = [t or "" for t in texts()[:40]]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(sample)] == [lib.encode_ordinary(t) for t in sample]


def test_dataframe(spark, both):
    _, lib = both
    df = spark.createDataFrame([(1, "Hello world", 3), (None, None, 4), (2, "", 5), (1, "Hello world", 6)], "doc_id long, text string, n_tokens int")
    rows = byte_bpe.decode(byte_bpe.encode(df)).collect()
    ids = np.array(lib.encode_ordinary("Hello world"), "<u4").tobytes()
    got = sorted([(r["doc_id"], r["n_tokens"], hashlib.sha256(r["token_ids"]).hexdigest(), bytes(r["decoded"])) for r in rows], key=str)
    one = (1, len(ids) // 4, hashlib.sha256(ids).hexdigest(), b"Hello world")
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([one, one, (2, 0, empty, b""), (None, 0, empty, b"")], key=str)
    assert byte_bpe.encode(df.limit(0)).count() == 0


def test_pipeline_tasks_hold_one_worker(spark):
    """Encoder and decoder do not run side by side in one task, and a decoder needs no tables of the encoder."""
    import corpus_pipeline

    texts = [(1, "one two"), (2, None), (None, "drei\nfünf")]
    out = corpus_pipeline.token_ids(spark, spark.createDataFrame(texts, "doc_id long, text string"), "")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    assert {(r["doc_id"], r["decoded_sha256"]) for r in out.collect()} == {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts}
    bpe = byte_bpe.load(P.path(byte_bpe.VOCAB), P.PATTERN)
    ids = bpe.encode(["für 1 text"])[0]
    assert byte_bpe.joined(byte_bpe._tokens(byte_bpe._ranks(P.path(byte_bpe.VOCAB))), ids).decode() == "für 1 text"
