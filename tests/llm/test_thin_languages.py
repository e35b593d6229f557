"""Documents of rare languages and scripts are judged by wider bands."""

import random

import pytest

from quire.llm import fertility as ft

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string"


def test_thin_languages_are_judged(spark):
    rng = random.Random(6)
    vocab = "river stone walked quietly over every morning light house garden with some other people and then later near".split()
    clean = [" ".join(rng.choice(vocab) for _ in range(rng.randint(60, 160))) for _ in range(100)]
    junk = [" ".join(w.upper() + "%%%###" for w in t.split()) for t in clean[:3]]
    thai = " ".join("ก" * rng.randint(1, 3) + "ข" * rng.randint(0, 3) + "%%#" for _ in range(90))
    rows = [(i, t, "en") for i, t in enumerate(clean[:90])] + [(90 + i, t, "xx") for i, t in enumerate(clean[90:])]
    rows += [(200, junk[0], "xx"), (201, junk[1], "yy"), (202, junk[2], None), (203, thai, "th"), (204, clean[0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in ft.rules(df).collect()}
    assert len(got) == len(rows)
    assert not any(got[i]["base_failed"] for i in (200, 201, 202, 203, 204))
    assert not any(got[i]["kept"] for i in (200, 201, 202, 203)) and got[204]["kept"]
    assert all(got[i]["kept"] != got[i]["base_failed"] for i in range(100))
    one = ft.drop_rejected(df, by_row=True)
    assert one.columns == df.columns and {r["doc_id"] for r in one.collect()} == {i for i, r in got.items() if r["kept"]}
