"""R6 terms, R5 levels, R3 agreement, X3 in SQL."""

import random

from quire.functions.spans import register_annotator
from quire.operators import annotate as an
from quire.operators import terms as tm


def plain(text, codes):
    """Leftmost longest, word by word."""
    import re
    spans = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]+", text or "")]
    out, i = [], 0
    while i < len(spans):
        for n in range(tm.MAX_WORDS, 0, -1):
            run = " ".join(w for *_, w in spans[i:i + n])
            if i + n <= len(spans) and run in codes:
                out.append((i, n, spans[i][0], spans[i + n - 1][1], run, codes[run]))
                i += n - 1
                break
        i += 1
    return out


def test_longest_leftmost(spark):
    rng = random.Random(5)
    words = ["the", "cat", "Sat", "on", "élan", "mat", "a"]
    docs = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "!", "  "]) for _ in range(rng.choice([0, 1, 5, 60])))) for i in range(40)]
    docs += [(99, None), (98, "the cat " * 50), (97, "a" + " a" * 200)]
    terms = {" ".join(rng.choice(words).lower() for _ in range(rng.randint(1, 8))) for _ in range(60)} - {"the", "on"}
    codes = {t: f"c{len(t)}" for t in terms} | {"a a a": "c3", "cat the": "ct"}
    rows = [(t, c) for t, c in codes.items()] + [("a a a", "z"), (" ".join(["mat"] * 9), "long"), ("", "none"), (None, "n")]
    got = tm.coded(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "term string, code string"))
    found = sorted((r.doc_id, r.pos, r.n_words, r.start_offset, r.end_offset, r.term, r.code) for r in got.collect())
    assert found == sorted((i, *m) for i, t in docs for m in plain(t, codes))


def test_words_are_spread_and_carry_few_neighbours(spark):
    """One file of one row group is walked by all tasks, and however long a
    text, a word's row holds a stretch of words, offsets included."""
    text = "".join(f"{w}{', ' if i % 3 else ' -- '}" for i, w in enumerate(["Élan", "cat", "a"] * 70))
    docs = spark.createDataFrame([(i, text, i) for i in range(40)], "doc_id long, text string, more int").coalesce(1)
    rows = tm.positions(docs, "doc_id", "text", tm.MAX_WORDS)
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = sorted(rows.where("doc_id = 7").collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(210)) and max(len(r.w) for r in got) <= 2 * tm.MAX_WORDS
    for r in got:
        end = r.base + sum(r.steps[:r.i + 1])
        assert r.w[r.i] == r.word == text[end - r.sizes[r.i]:end].lower()


def test_empty_code_list(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert tm.coded(docs, spark.createDataFrame([], "term string, code string")).collect() == []


def test_levels(spark):
    docs = spark.createDataFrame([(1, "One thing. Two\nthat! this"), (2, ""), (3, None), (4, "...that")], "doc_id long, text string")
    got = sorted((r.doc_id, r.level, r.unit_no, r.start_offset, r.end_offset, r.label, r.sent_no)
                 for r in an.levels(docs, r"([^.!?]+[.!?]*)", r"\b(thing|this|that)\b").collect())
    assert [g for g in got if g[0] == 1] == [
        (1, "document", 0, 0, 25, None, None), (1, "sentence", 0, 0, 10, None, 0), (1, "sentence", 1, 10, 20, None, 1),
        (1, "sentence", 2, 20, 25, None, 2), (1, "term", 0, 4, 9, "thing", 0), (1, "term", 1, 15, 19, "that", 1), (1, "term", 2, 21, 25, "this", 2)]
    assert [g for g in got if g[0] == 2] == [(2, "document", 0, 0, 0, None, None)] and not [g for g in got if g[0] == 3]
    assert [g[:5] + g[6:] for g in got if g[0] == 4] == [(4, "document", 0, 0, 7, None), (4, "sentence", 0, 3, 7, 0), (4, "term", 0, 3, 7, 0)]


def test_agreement_against_sets(spark):
    rng = random.Random(8)
    schema = "doc_id long, start_offset long, end_offset long, label string, prob double"

    def some():
        out = []
        for _ in range(60):
            s = rng.randrange(90)
            out.append((rng.randrange(4), s, s + rng.randint(0, 10), rng.choice("xyz"), 0.8))
        return out

    a, b = some(), some()
    docs = spark.createDataFrame([(i, "t" * 100) for i in range(4)] + [(9, None)], "doc_id long, text string")
    got = {r.label: r for r in an.agreement(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), docs).collect()}
    for label in "xyz":
        one, two = ({(d, c) for d, s, e, x, _ in rows if x == label for c in range(s, e)} for rows in (a, b))
        r = got[label]
        assert (r.n_both, r.n_a_only, r.n_b_only, r.n_neither) == (len(one & two), len(one - two), len(two - one), 400 - len(one | two))
        pa, pb, same = len(one) / 400, len(two) / 400, 1 - len(one ^ two) / 400
        chance = pa * pb + (1 - pa) * (1 - pb)
        assert abs(r.kappa - (same - chance) / (1 - chance)) < 1e-12


def test_annotator_in_sql(spark):
    spark.createDataFrame([(1, "testing a testing"), (2, None), (3, "none")], "doc_id long, text string").createOrReplaceTempView("quire_texts")
    register_annotator(spark)
    got = spark.sql("SELECT d.doc_id, s.* FROM quire_texts d, LATERAL span_rows(d.text, '\\\\b(testing)\\\\b') s").collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 7, "testing", 0.8), (1, 10, 17, "testing", 0.8)]
