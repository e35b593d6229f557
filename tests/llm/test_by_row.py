"""The pipeline's filters act on rows: null ids, and ids with several texts."""

import random

import corpus_pipeline as cp
from quire.llm import near_dedup as nd

SCHEMA = "doc_id long, text string, lang string, n_chars long"


def texts(n, seed=3):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(900)]
    return [" ".join(rng.choice(vocab) for _ in range(80)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", n) for n, (i, t) in enumerate(rows)], SCHEMA)


def left(df):
    return sorted(r["n_chars"] for r in df.collect())


def test_quality_rules(spark):
    a, b = texts(2)
    rows = [(1, a), (2, "short"), (None, "short"), (None, b), (3, a + " end"), (3, "short"), (None, None), (4, None)]
    assert left(cp.quality_rules(spark, frame(spark, rows), "")) == [0, 3, 4]


def test_near_duplicates(spark, monkeypatch):
    a, b, c, d, e = texts(5)
    rows = [(7, a), (None, a), (None, a + " x"), (5, b), (None, c), (None, c), (None, c + " y"), (6, d), (6, e), (9, e + " z"),
            (2, d + " u"), (-4, b + " v"), (None, None), (None, None), (None, " "), (None, " "), (8, "")]
    # 5 and 6's first text fall to smaller ids; 6's other text stays, and one row of the null-id group
    got = left(nd.drop_near_duplicates(frame(spark, rows), by_row=True))
    assert [n for n in got if n not in (4, 5, 6)] == [0, 8, 10, 11, 12, 13, 14, 15, 16]
    assert len([n for n in got if n in (4, 5, 6)]) == 1
    for rounds, block in ((1, 2), (0, 3)):
        monkeypatch.setattr(nd, "PIVOT_ROUNDS", rounds)
        monkeypatch.setattr(nd, "BLOCK", block)
        assert len(left(cp.near_duplicates(spark, frame(spark, rows), ""))) == len(got)


def test_decontamination(spark, tmp_path):
    a, b = texts(2)
    item = "one two three four five six seven eight"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, a), (None, f"{a} {item}"), (None, b), (2, f"{item} {b}"), (2, b), (None, None), (3, "")]
    assert left(cp.decontamination(spark, frame(spark, rows), str(tmp_path))) == [0, 2, 4, 5, 6]


def test_same_as_by_id_without_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, other = (nd.drop_near_duplicates(docs, by_row=f).select("doc_id").collect() for f in (False, True))
    assert sorted(one) == sorted(other)
