"""F20/X3 rule annotator: native offsets equal the Python search loop."""

import random

from pyspark.sql import functions as F

from quire.functions.spans import find_spans, python_spans, rule_spans

WORDS = ["testing", "test", "xtesting", "testingx", "é", "😀", "a", "testing,", ".", "\n", "Testing", "ünd"]


def _texts(n=300, seed=5):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(0, 30))) for _ in range(n)] + [None, ""]


def test_native_equals_python(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r.id: r.s for r in df.select("id", rule_spans("text").alias("s")).collect()}
    for i, t in enumerate(texts):
        want = find_spans(t)
        if want is None:
            assert got[i] is None
            continue
        assert [(s.start_offset, s.end_offset, s.label, s.prob) for s in got[i]] == \
               [(w["start_offset"], w["end_offset"], w["label"], w["prob"]) for w in want]


def test_offsets_slice_to_label(spark):
    df = spark.createDataFrame([("é testing 😀 testing, testing",)], "text string")
    r = df.select("text", rule_spans("text").alias("s")).first()
    assert [r.text[s.start_offset:s.end_offset] for s in r.s] == ["testing"] * 3
    assert [s.start_offset for s in r.s] == [2, 12, 21]


def test_skip_one_python_plugin(spark):
    df = spark.createDataFrame([("ababab",)], "text string")
    plain = df.select(rule_spans("text", pattern="(ab)").alias("s")).first().s
    skip = df.select(python_spans(pattern="(ab)", skip_one=True)(F.col("text")).alias("s")).first().s
    assert len(plain) == 3 and len(skip) == 2


def test_custom_annotator_plugin(spark):
    def upper_words(text):
        out, pos = [], 0
        for w in text.split(" "):
            if w.isupper():
                out.append({"start_offset": pos, "end_offset": pos + len(w), "label": "CAPS", "prob": 1.0})
            pos += len(w) + 1
        return out

    df = spark.createDataFrame([("a BIG word OK",)], "text string")
    s = df.select(python_spans(upper_words)(F.col("text")).alias("s")).first().s
    assert [(x.start_offset, x.end_offset, x.label) for x in s] == [(2, 5, "CAPS"), (11, 13, "CAPS")]


def test_many_matches_block_prefix(spark):
    import random as _r

    rnd = _r.Random(2)
    texts = []
    for k in (1, 2, 3, 10, 17, 101, 1000):
        texts.append("".join(" " * rnd.randrange(0, 4) + "é" * rnd.randrange(0, 2) + " testing" for _ in range(k)))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", rule_spans("text").alias("s")).collect():
        want = find_spans(r.text)
        assert [(s.start_offset, s.end_offset) for s in r.s] == [(w["start_offset"], w["end_offset"]) for w in want]


def test_spans_apart_leave_a_character():
    from quire.functions.spans import find_spans_apart

    assert [x["start_offset"] for x in find_spans("aaaa", "(a)")] == [0, 1, 2, 3]
    assert [x["start_offset"] for x in find_spans_apart("aaaa", "(a)")] == [0, 2]
    assert find_spans_apart(None) is None and find_spans_apart("none") == []
