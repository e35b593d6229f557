"""SpotSigs fingerprints against a plain version over all texts."""

import hashlib
import random
from collections import Counter

import pytest

from quire.llm import spot_signatures as S

SCHEMA = "doc_id long, text string, lang string, bucket string, h string, guest string"


def plain_words(text):
    out = []
    for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split(" "):
        out += [x.rstrip(".,;:!?") for x in w.replace("\t", "\n").replace("\r", "\n").split("\n")]
    return [w for w in out if w]


def plain_anchors(rows):
    docs, words, total = Counter(), {}, Counter()
    for _, text, lang in rows:
        docs[lang or ""] += 1
        for w in set(plain_words(text)):
            words.setdefault(lang or "", Counter())[w] += 1
            total[w] += 1

    def best(c):
        return sorted(c, key=lambda w: (-c[w], w.encode()))[:S.ANCHORS]

    out = set(best(total))
    for label, n in docs.items():
        if n * S.LABEL_SHARE >= len(rows):
            out |= set(best(words.get(label, {})))
    return out


def plain_print(text, anchors):
    words = plain_words(text)
    found = set()
    for i, w in enumerate(words):
        chain = [x for x in words[i + 1:] if x not in anchors][:S.CHAIN]
        if w in anchors and len(chain) == S.CHAIN:
            found.add(" ".join([w, *chain]))
    if not found and words:
        found = {" ".join(words)}
    return {hashlib.md5(s.encode()).hexdigest()[:8] for s in found}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else float(not a and not b)


def brute(rows):
    anchors = plain_anchors(rows)
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        own, changed, other = (plain_print(t, anchors) for t in (text, edited, following))
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(own)), "".join(sorted(changed)),
                  pytest.approx(jaccard(own, changed)), pytest.approx(jaccard(own, other)))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    common = {"a": ["the", "of", "and", "to", "in"], "b": ["de", "la", "el", "que", "y"]}
    rows = []
    for i in range(n):
        lang = rng.choice("aab")
        size = rng.choice([0, 1, 2, 5, 40, 300])
        text = " ".join(rng.choice(common[lang]) if rng.random() < 0.4 else f"é{lang}{rng.randrange(300)}" + rng.choice(["", ".", ",\n"]) for _ in range(size))
        if rows and rng.random() < 0.2:
            text = rng.choice(rows)[1]
        rows.append((i * 3 - 50, rng.choice([text, text, (text or "").upper()]), rng.choice([lang, lang, None])))
    rows[3] = (rows[3][0], None, "a")
    return rows


def run(spark, rows, schema=SCHEMA):
    return S.edited_fingerprints(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(5))


@pytest.mark.parametrize("seed,bucket", [(1, 2 << 20), (2, 300), (3, 4000)])
def test_against_plain_version(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket)
    rows = corpus(seed, 90)
    got = [tuple(r) for r in run(spark, rows).collect()]
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert r[1:] == want[r[0]], r[0]


def test_shares(spark):
    """A text of common and content words keeps the signatures of the part that stays."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(9000)}" for _ in range(600)), "en") for i in range(60)]
    for r in run(spark, rows).collect():
        assert 0.35 < r["near_edited"] < 0.65 and r["near_next"] < 0.05


def test_edges(spark):
    assert run(spark, [(1, "one two", "x")]).drop("lang").collect()[0]["near_next"] == 1.0
    assert run(spark, []).collect() == []
    rows = [(None, "a b", None), (7, "a b c", None), (7, "a b c", None), (7, "zzz", None), (8, "", None), (9, None, None), (None, None, None)]
    got = run(spark, rows).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    empty = [r for r in got if r["n_chars"] == 0]
    assert len(empty) == 3 and all(r["fingerprint"] == "" and r["near_edited"] == 1.0 for r in empty)
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 5}) == 1


def test_one_id_many_rows(spark, monkeypatch):
    """A third of all rows under one id is spread over several buckets."""
    monkeypatch.setattr(S, "BUCKET_BYTES", 200)
    rows = [(i if i % 3 else 1000, f"text the {i} of a b c {i}", "en") for i in range(300)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert S.edited_fingerprints(df).count() == 300
    sizes = S.with_next(df, "doc_id", "text").where("doc_id = 1000 AND NOT guest").groupBy("bucket").count().collect()
    assert len(sizes) > 5 and sum(r["count"] for r in sizes) == 100


def test_long_text(spark):
    text = " ".join(f"the w{i} of" for i in range(150_000))
    got = run(spark, [(1, text, "en"), (2, "short the of", "en")]).where("doc_id = 1").collect()[0]
    assert got["n_chars"] == len(text) and 0 < got["near_edited"] <= 1


def test_pruned_jaccard():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ({f"{rng.randrange(30):08x}" for _ in range(rng.randint(0, 25))} for _ in range(2))
        exact = jaccard(a, b)
        assert S.pruned_jaccard(sorted(a), sorted(b)) == pytest.approx(exact)
        for percent in (50, 80, 100):
            got = S.pruned_jaccard(sorted(a), sorted(b), percent)
            assert got == pytest.approx(exact) if 100 * exact >= percent else got in (0.0, pytest.approx(exact))


def test_length_partitions():
    """Two sizes that can reach the threshold lie in one partition or in neighbours."""
    for percent in (50, 80, 90):
        parts = [S.length_partition(n, percent) for n in range(1, 300)]
        assert parts == sorted(parts)
        for n in range(1, 200):
            assert S.length_partition(n * 100 // percent, percent) - S.length_partition(n, percent) <= 1


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    from quire.llm import near_dedup as nd

    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(block)
    bases = [[rng.choice(["the", "of"]) if rng.random() < 0.4 else f"w{rng.randrange(5000)}" for _ in range(n)] for n in (30, 80, 81, 200)]
    rows = []
    for i in range(90):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = f"w{rng.randrange(5000)}"
        rows.append((i, " ".join(w), "en"))
    rows += [(200, None, "en"), (201, "", "en"), (202, "alone", "en")]
    anchors = ["of", "the"]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in S.near_duplicates(df, anchors=anchors).collect()}
    prints = {i: plain_print(t, set(anchors)) for i, t, _ in rows}
    comp = {i: i for i in prints}
    edges = [(a, b) for a in prints for b in prints if a < b and prints[a] and prints[b] and jaccard(prints[a], prints[b]) >= 0.8]
    for _ in prints:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert len(set(comp.values())) < 60 and got == {i: (c, c == i) for i, c in comp.items()}


def test_spots_of_neighbours_are_hashed_once(monkeypatch):
    """An edited text's spots that stand in one of its two texts are not hashed again."""
    import pandas as pd

    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "Ba,", "co", "du!?", "eg"]) for _ in range(400)) for _ in range(12)] + ["", " . ", "the", "é of a b c d."]
    known = frozenset([b"the", b"of"])
    want = [S.signatures(t, known) for t in texts]
    real, calls = S.hashlib.md5, []
    monkeypatch.setattr(S.hashlib, "md5", lambda s: calls.append(s) or real(s))
    rows = pd.DataFrame({"bucket": 0, "guest": [False] * len(texts) + [True], "doc_id": range(len(texts) + 1), "text": [*texts, texts[0]]})
    out = pd.concat(list(S._edits([rows[:5], rows[5:]], known)))
    assert len(calls) < 1.1 * (sum(map(len, want)) + len(want[0]))
    assert out["fingerprint"].tolist() == ["".join(w) for w in want]
    follows = [*texts[1:], texts[0]]
    edited = [t[:len(t) - len(t) // 3] + f[:len(t) // 3] for t, f in zip(texts, follows, strict=True)]
    assert out["edited_fingerprint"].tolist() == ["".join(S.signatures(t, known)) for t in edited]
    assert out["near_next"].tolist() == pytest.approx([jaccard(set(a), set(b)) for a, b in zip(want, [*want[1:], want[0]], strict=True)])
