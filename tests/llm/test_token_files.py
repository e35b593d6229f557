"""Token files: encoding as the library does, exact round trip, single documents."""

import random
import zlib

import numpy as np
import pytest

from quire.llm import token_files as tf

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(P.path(tf.VOCAB))


def test_words_equal_library(library):
    rng, enc = random.Random(2), tf.WordEncoder(P.path(tf.VOCAB))
    al = "aZé.',!?:; \n\t01ß漢\"-<|>İΣ́ \xa0_"
    texts = ["", " ", "<|endoftext|> a<|startoftext|>b", "don't. \"Hi.\"", "\x1ca\x1db", "ΑΣ. ΑΣ", "Ⅷ. x"]
    texts += ["".join(rng.choice(al) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_blocks_join_and_cut_batches(monkeypatch, library):
    """Words are looked up once a block: small batches are joined, long ones
    cut, and every row comes once and in order."""
    pa = pytest.importorskip("pyarrow")
    monkeypatch.setattr(tf, "BLOCK_BYTES", 100)
    texts = ["ab cd"] * 30 + [None, "", "x " * 200, "tail\tEnd.\nä"] + ["ab cd"] * 50
    rows = pa.table({"doc_id": pa.array([None, *range(1, len(texts))], pa.int64()), "text": pa.array(texts, pa.string())})
    found = list(tf.blocks(rows.to_batches(max_chunksize=7)))
    assert pa.concat_tables(found).to_pylist() == rows.to_pylist()
    sizes = [sum(len((t or "").encode()) for t in b["text"].to_pylist()) for b in found]
    assert len(found) < len(rows) / 7 and sorted(sizes)[-2] < 200
    enc = tf.WordEncoder(P.path(tf.VOCAB))
    for b in found:
        ids, ends = enc.token_ids(b["text"].combine_chunks())
        own = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert own == [library.encode(t or "", add_special_tokens=False).ids for t in b["text"].to_pylist()]


def test_shards():
    rng = np.random.default_rng(0)
    docs = {i: rng.integers(0, 49408, n).astype("<u4") for i, n in enumerate([0, 1, 5, 30_000])}
    for dictionary in (b"", bytes(rng.integers(0, 256, 4096, dtype=np.uint8))):
        w = tf.ShardWriter(dictionary)
        data = b""
        for k, ids in docs.items():
            w.add(k, ids)
            if k % 2:
                data += w.finish() + b"\n"
        assert [len(index) for _, index, _, _ in tf.shards(data)] == [2, 2]
        for k, ids in docs.items():
            assert tf.fetch(data, dictionary, k).tolist() == ids.tolist()
        assert tf.fetch(data, dictionary, 99) is None
        with pytest.raises(ValueError, match="dictionary"):
            tf.fetch(data, b"another", 1)
    with pytest.raises(ValueError, match="cut short"):
        list(tf.shards(data[:-3]))


def test_round_trip(spark, library, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-3, None, "x"), (None, "Null id!", "x"), (10 ** 6, "", None), (5, "Twice", "y")], docs.schema)
    docs = docs.union(extra)
    path = f"file://{tmp_path}/files"
    tf.write(docs, path)
    got = tf.read(spark, path).orderBy("start", "file_no", "ord").collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    left = sorted([(r["doc_id"], zlib.crc32(np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
                   for r in rows], key=str)
    assert sorted([(r["doc_id"], r["ids_crc32"]) for r in got], key=str) == left
    start = 0
    for r in got:
        assert (r["start"], len(r["token_ids"]) // 4) == (start, r["n_tokens"])
        start += r["n_tokens"]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tf.write(docs, f"file://{tmp_path}/none")
    assert tf.read(spark, f"file://{tmp_path}/none").count() == 0


class Seen:
    """The library, with a list of the words it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, []

    def encode(self, text, **kw):
        self.words += text.split()
        return self.tokenizer.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.words += [w for t in texts for w in t.split()]
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_library_sees_each_piece_once(library):
    """A word is not encoded again for the punctuation that closes it."""
    enc = tf.WordEncoder(P.path(tf.VOCAB))
    enc.tokenizer = seen = Seen(enc.tokenizer)
    texts = ['River. RIVER, river) river" "river', "River; river) Äther äther] don't", 'River" river.\nriver']
    for text in texts:
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(seen.words) == sorted(["river", ".", ",", ")", '"', '"river', ";", "Äther", "äther", "]", "don't"])


def test_closing_marks_and_letters(library):
    """Every mark and every letter that is cut off or folded gives the library's ids."""
    enc, rng = tf.WordEncoder(P.path(tf.VOCAB)), random.Random(4)
    assert enc.apart and enc.folds
    letters = [chr(c) for c in range(0x41, 0x140) if chr(c).isalpha()] + ["́", "̸", "ſ", "ß", "1"]
    words = [rng.choice(letters) + w + m for w in ("", "a", "Él", "é") for m in (*tf.MARKS, "'s", "'", "<", ">", "|", "…")]
    words += ["".join(rng.choices(letters, k=rng.randint(1, 6))) + "".join(rng.choices(tf.MARKS + "'<|>", k=rng.randint(0, 3))) for _ in range(4000)]
    whole = tf.WordEncoder(P.path(tf.VOCAB))
    whole.apart = whole.folds = False       # as for a vocabulary that fails the probes
    for w, ids, same in zip(words, enc.encode(words), whole.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(w, add_special_tokens=False).ids, repr(w)
        assert ids == same
    pa, pc = pytest.importorskip("pyarrow"), pytest.importorskip("pyarrow.compute")
    points = [chr(c) for c in range(1, 0x400)]
    simple = pc.match_substring_regex(pa.array(points), tf.SIMPLE).to_pylist()
    assert simple == [c.isalpha() and c < "İ" for c in points]


def test_known_pieces_are_bounded(monkeypatch, library):
    """Pieces used longest ago go, those of the batch at hand stay, ids are the library's."""
    monkeypatch.setattr(tf, "CACHED_WORDS", 60)
    monkeypatch.setattr(tf, "JOINED_WORDS", 7)
    enc, rng = tf.WordEncoder(P.path(tf.VOCAB)), random.Random(5)
    for k in range(60):
        texts = [" ".join(rng.choice(["the", "Of,", f"w{rng.randint(0, 300)}", "x" * rng.randint(1, 40) + "!", "漢字"])
                          for _ in range(rng.choice([0, 3, 30]))) for _ in range(rng.randint(1, 5 if k % 9 else 40))]
        for t, ids in zip(texts, enc.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
        own = {p for w in " ".join(texts).split(" ") for p in (w, w.lower(), w.rstrip(tf.MARKS).lower(), w[len(w.rstrip(tf.MARKS)):])}
        assert len(enc.known) == len(enc.at) == len(enc.size) == len(enc.used) == len(set(enc.known.to_pylist()))
        assert len(enc.known) <= max(60, len(own))
