"""Registered queries against their SQL, and the stages against brute force."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from quire.llm.queries import ORACLES, QUERIES
from tools.oracle_check import table_hash

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns) and len(rows) == len(want) > 0
    assert table_hash(df.columns, rows)[0] == table_hash(rel.columns, want)[0]


def test_pipeline_stages(spark):
    """Each stage against a plain version of itself on its own input."""
    import base64

    import public_tokenizers as P
    import tiktoken
    from test_decontaminate import brute as contained
    from test_line_dedup import brute as lines_of
    from test_near_dedup import brute as groups

    from quire.llm import byte_bpe, fertility
    from quire.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, inputs = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stored(stage(spark, docs, SF), "test-stage")
    assert all(d.columns == columns for d in inputs)
    rows = [{r["doc_id"]: r for r in d.collect()} for d in inputs]
    ok = {r["doc_id"] for r in fertility.rules(inputs[0]).where("kept").collect()}
    assert set(rows[1]) == ok and all(rows[1][i] == rows[0][i] for i in ok)
    cut = lines_of([(i, r["text"]) for i, r in rows[1].items()])
    assert {i: r["text"] for i, r in rows[2].items()} == {i: v[0] for i, v in cut.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2].values())
    kept = {i for i, v in groups([(i, r["text"]) for i, r in rows[2].items()], 5, 80).items() if v[2]}
    assert set(rows[3]) == kept
    items = [(r["item_id"], r["text"], 0) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, *_ in contained([(i, r["text"]) for i, r in rows[3].items()], items)}
    assert set(rows[4]) == set(rows[3]) - leaks and all(rows[4][i] == rows[3][i] for i in rows[4])
    with open(P.path(byte_bpe.VOCAB), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {r["doc_id"]: r for r in docs.collect()}
    assert set(out) == set(rows[4])
    for i, r in out.items():
        ids = lib.encode_ordinary(rows[4][i]["text"])
        assert r["n_tokens"] == len(ids) and [int.from_bytes(r["token_ids"][k:k + 4], "little") for k in range(0, 4 * len(ids), 4)] == ids
        assert r["decoded_sha256"] == hashlib.sha256(rows[4][i]["text"].encode()).hexdigest()
