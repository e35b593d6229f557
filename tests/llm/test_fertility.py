"""Base counts by brute force, bands by recomputation, clean texts kept."""

import math
import random
import re

import pytest

from quire.llm import fertility as ft

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, kept string, band int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def texts():
    rng = random.Random(9)
    vocab = "river stone walked quietly over every morning light house garden with some other people and then later near".split()
    clean = [" ".join(rng.choice(vocab) for _ in range(rng.randint(60, 160))) for _ in range(90)]
    clean = [re.sub(r"(\w+ \w+) ", r"\1\n", t, count=2) for t in clean]
    junk = [" ".join(w.upper() + "%%%###" for w in t.split()) for t in clean[:6]]
    odd = [None, "", " \n\t", "a b a b a b a b " * 20, "x\x1cy\x85z é\xa0ü " * 30, "line one\nline one\n\n\n#*$%&|<>", "a a a", "b\x0bc\x0cd\re"]
    return clean, junk, odd


@pytest.fixture(scope="module")
def judged(spark):
    clean, junk, odd = texts()
    rows = [(i, t, "en" if i != 95 else None, "x", i) for i, t in enumerate(clean + junk + odd)] + [(None, clean[0], "en", "x", 0)]
    return rows, {r["doc_id"]: r for r in ft.rules(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_base_counts(judged):
    rows, got = judged
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == counts(text)


def test_verdicts(judged):
    rows, got = judged
    clean, junk, _ = texts()
    for i in range(len(clean)):
        assert got[i]["kept"] != got[i]["base_failed"]
    assert not any(got[len(clean) + i]["kept"] for i in range(len(junk)))
    assert got[95]["band"] == "script:Latin" and not got[95]["kept"]      # junk without a language
    assert not any(r["kept"] for r in got.values() if r["base_failed"])


def test_measures(judged):
    import numpy as np
    import public_tokenizers as P
    import sentencepiece
    from quire.llm import byte_bpe

    rows, got = judged
    bpe = byte_bpe.load(P.path(byte_bpe.VOCAB), P.PATTERN)
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(ft.PIECES))
    for doc_id, text, *_ in rows[:5] + rows[92:95]:
        w = WORD.findall(text)
        ids = [x for word in w for x in np.frombuffer(bpe.encode([" " + word])[0], "<u4").tolist()]
        pieces = [x for word in w for x in sp.encode(word)]
        share = [ids.count(x) / len(ids) for x in set(ids)]
        r = got[doc_id]
        assert r["n_tokens"] == len(ids) and math.isclose(r["chars_per_token"], sum(map(len, w)) / len(ids))
        assert math.isclose(r["fallback_share"], sum(map(sp.is_byte, pieces)) / len(pieces))
        assert math.isclose(r["entropy"], -sum(p * math.log2(p) for p in share))


def test_clean_labels_kept(spark):
    sf = "/root/testdata/sf0.01"
    got = ft.rules(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    clean = got.where("quality = 1 AND NOT base_failed")
    assert clean.where("kept").count() >= 0.99 * clean.count() > 100
    low = got.where("quality = 0 AND NOT base_failed")
    assert low.where("NOT kept").count() >= 0.5 * low.count()


def test_drop_and_empty(spark):
    clean, _, _ = texts()
    df = spark.createDataFrame([(1, clean[0], "en", "x", 1), (2, "short", "en", "y", 2), (None, "short", None, None, None)], SCHEMA)
    out = ft.drop_rejected(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == {1, None}
    assert ft.rules(df.limit(0)).count() == 0
    assert ft.rules(df.drop("lang")).where("band = 'lang:en'").count() == 0


def test_scripts():
    assert [ft.script_of(t) for t in ("abc", "где", "漢字かな", "12 !", "")] == ["Latin", "Cyrillic", "Han", "none", "none"]


def test_window_counts_by_document():
    import numpy as np

    rng = random.Random(2)
    docs = [[rng.randrange(4) for _ in range(rng.choice([0, 1, 2, 3, 9, 30]))] for _ in range(60)] + [list(range(3000)) * 2, []]
    got = ft.repeat_words(np.array([c for d in docs for c in d], np.int64), np.cumsum([len(d) for d in docs]))
    big = ft.repeat_words(np.array([c + (1 << 40) for d in docs for c in d], np.int64), np.cumsum([len(d) for d in docs]))
    for d, n, m in zip(docs, got.tolist(), big.tolist(), strict=True):
        grams = [tuple(d[i:i + 3]) for i in range(len(d) - 2)]
        seen = {g: grams.count(g) for g in set(grams)} if len(d) < 100 else dict.fromkeys(grams, 2)
        assert n == m == len({i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)})
    assert ft.repeat_words(np.array([], np.int64), np.array([0, 0])).tolist() == [0, 0]


def test_bands_have_no_switch(spark):
    """A document's band moves by degrees with the number of documents beside it."""
    figures = []
    for n in (0, 1, 30, 49, 50, 51, 3000):
        rows = [(i, "en", 4.0) for i in range(3000)] + [(10_000 + i, "xx", 6.0) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, lang string, cpt double").selectExpr(
            "doc_id", "concat('lang:', lang) AS band", "'Latin' AS script", "cpt AS chars_per_token", "0.0D AS fallback_share",
            "5.0D AS entropy", "100L AS n_tokens")
        m = df.unionByName(df.limit(1).selectExpr("-1L AS doc_id", "'lang:xx' AS band", "script", "chars_per_token", "fallback_share", "entropy", "n_tokens"))
        figures.append({r["band"]: r["chars_per_token_mid"] for r in ft._blended(m, df).collect()}["lang:xx"])
    assert figures == sorted(figures) and figures[0] == 4.0 and 5.9 < figures[-1] <= 6.0
    assert max(b - a for a, b in zip(figures[3:5], figures[4:6])) < 0.05


def test_words_keep_their_figures_when_the_table_is_renewed(monkeypatch):
    """A small table forgets words and takes others over from the one before;
    words taken over are not encoded again."""
    import numpy as np
    import public_tokenizers as P

    texts = [[f"w{i}x" for i in range(k, k + 12)] + ["the", "où"] * 3 for k in range(0, 60, 6)]
    codes = lambda m, t: np.array([m.known[w.encode()] for w in t], np.int64)
    fresh = ft.Meter(P.path(ft.byte_bpe.VOCAB), P.PATTERN, P.path(ft.PIECES))
    fresh.learn({w.encode() for t in texts for w in t})
    monkeypatch.setattr(ft, "CACHED_WORDS", 20)
    small = ft.Meter(P.path(ft.byte_bpe.VOCAB), P.PATTERN, P.path(ft.PIECES))
    made, encode = [], small._token_ids
    small._token_ids = lambda strs: made.extend(strs) or encode(strs)
    for t in texts:
        small.learn({w.encode() for w in t})
        assert len(small.known) <= 20 and len(small.known) == len(small.table[0])
        for x, y in zip(small.measures(codes(small, t), np.array([len(t)])), fresh.measures(codes(fresh, t), np.array([len(t)])), strict=True):
            assert x.tolist() == pytest.approx(y.tolist())
    assert made.count("the") == 1 and len(made) == len({w for t in texts for w in t})
