"""Token ids in compressed binary files with access to single documents.

File: one or more shards, each

    frames | index | footer

A frame is one document's ids (little-endian, 2 or 4 bytes an id), compressed
alone with zstandard and one dictionary shared by all files. The index holds
per document its id, whether the id is null, the frame's place and length and
the number of ids. The footer holds the index place, the number of documents,
the bytes per id, the SHA-256 of the dictionary, the shard's length and the
magic value, whose last byte is a line end: Spark's text writer puts it there,
so that files of raw bytes are committed task by task on any file system.
A reader walks from the end of the file, shard by shard, and opens only the
frames it wants.

The dictionary is trained on serialized id arrays of a bounded sample:
about ``DICT_DOCS`` documents (at most twice as many) drawn by id hash, those
of at most ``DICT_CHARS`` characters. It affects file sizes only.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import common as C
from quire.session import checkpoint_dir

VOCAB = "word_bpe_49k.json"
DICT_DOCS, DICT_CHARS, DICT_BYTES = 1024, 4096, 64 << 10
FILE_TEXT_BYTES = 32 << 20
SHARD_BYTES = 4 << 20
LEVEL = 1
MAGIC = b"IDFRAME\n"
CACHED_WORDS, JOINED_WORDS = 400_000, 2_000
BLOCK_BYTES = 4 << 20
# Closing punctuation: no apostrophe, and nothing of the added tokens ``<|...|>``.
MARKS = ".,!?;:\"#$%&()*+-/=@[\\]^_`{}~"
WORD_END = "</w>"
# The letters below U+0130, each of which is composed by itself.
SIMPLE = "^[A-Za-zªµºÀ-ÖØ-öø-\u012f]+$"
_PROBES = ["word", "Word", "ÜBER", "naïve", "straße", "ĀĐĦ", "ª", "x" * 40]
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("at", "<u8"), ("size", "<u4"), ("ids", "<u4")])
_FOOTER = struct.Struct("<QQB32sQ")


# --- encoding -----------------------------------------------------------------

class WordEncoder:
    """Ids by the ``tokenizers`` library, which sees each distinct piece once.

    For a vocabulary whose pre-tokenizer drops white space no token spans two
    words, so a text's ids are its words' ids in a row. A word of simple
    letters and closing punctuation is two pieces, its letters (capitals as
    small letters where the vocabulary folds them; the probes tell whether
    both hold) and its punctuation; every other word is one piece. All pieces
    of a batch are found at once in one Arrow array, and the new ones go to
    the library as texts of ``JOINED_WORDS`` pieces each. Simple letters are
    one pre-token, so where the vocabulary marks the last token of each, the
    marks cut such a text into its pieces; every other piece is found by its
    place in the text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.apart = all(one(w + m) == one(w) + one(m) for w in _PROBES for m in (*MARKS, MARKS))
        self.folds = all(one(w) == one(w.lower()) for w in _PROBES if w.isascii())
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        # The pieces known, the place and number of their ids, and the batch that last used them.
        self.known, self.ids = pa.array([], pa.large_string()), np.zeros(0, "<u4")
        self.at, self.size, self.used, self.batch = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _pieces(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """First and second piece of every word; the second may be empty."""
        core = pc.utf8_rtrim(words, MARKS) if self.apart else words
        simple = pc.match_substring_regex(core, SIMPLE)
        data, bounds = C.utf8_of(words)
        tail = np.where(simple, np.diff(bounds) - pc.binary_length(core).to_numpy(), 0)
        rest = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(np.concatenate(([0], np.cumsum(tail)))),
                                                pa.py_buffer(data[C.ranges(bounds[1:] - tail, tail)]))
        low = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core) if self.folds else core
        return pc.if_else(simple, low, words), rest

    def _ids(self, part: pa.Array, simple: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row and the number of each."""
        text = " ".join(part.to_pylist())
        if simple:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cut = np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1))
        if not simple or len(cut) != len(part) + 1:
            found = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            starts = np.concatenate(([0], np.cumsum(pc.utf8_length(part).to_numpy() + 1)))
            cut = np.searchsorted(np.fromiter((a for a, _ in found.offsets), np.int64, len(ids)), starts)
        return ids, np.diff(cut)

    def _drop(self, more: int) -> None:
        """Lets go of the pieces used longest ago if ``more`` would not fit; those of this batch stay."""
        if len(self.known) + more <= CACHED_WORDS:
            return
        since = np.sort(self.used)[-(CACHED_WORDS // 2):][0] if len(self.used) else 0
        keep = np.flatnonzero(self.used > min(since, self.batch - 1))
        self.known, self.ids = self.known.take(pa.array(keep)), self.ids[C.ranges(self.at[keep], self.size[keep])]
        self.size, self.used = self.size[keep], self.used[keep]
        self.at = np.cumsum(self.size) - self.size

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Place of each of the distinct pieces among the known; new ones are learned."""
        self.batch += 1
        found = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(found.is_null())
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        old = place >= 0
        self.used[place[old]] = self.batch
        if not len(new):
            return place
        before = np.cumsum(self.used == self.batch) - 1
        held = place[old]
        self._drop(len(new))
        if len(self.used) < len(before):
            place[old] = np.flatnonzero(self.used == self.batch)[before[held]]
        simple = pc.match_substring_regex(new, SIMPLE)
        order = np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")
        n, ids, size = pc.sum(simple).as_py() or 0, [self.ids], [self.size]
        new = new.take(pa.array(order))
        for first, end in ((0, n), (n, len(new))):
            for i in range(first, end, JOINED_WORDS):
                own, count = self._ids(new.slice(i, min(end - i, JOINED_WORDS)), first < n)
                ids.append(own)
                size.append(count)
        place[np.flatnonzero(~old)[order]] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.ids, self.size = np.concatenate(ids), np.concatenate(size)
        self.at = np.cumsum(self.size) - self.size
        self.used = np.concatenate((self.used, np.full(len(new), self.batch)))
        return place

    def token_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place behind each text's last."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        for mark in "\n\t\r":
            texts = pc.replace_substring(texts, mark, " ")
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten().dictionary_encode()
        both = pa.concat_arrays(self._pieces(flat.dictionary)).dictionary_encode()
        place = self.places(both.dictionary)[both.indices.to_numpy().reshape(2, -1).T]
        pool, size = self.ids[C.ranges(self.at[place].ravel(), self.size[place].ravel())], self.size[place].sum(axis=1)
        codes = flat.indices.to_numpy()
        count = size[codes]
        upto = np.concatenate(([0], np.cumsum(count)))
        at = np.repeat((np.cumsum(size) - size)[codes] - upto[:-1], count)
        at += np.arange(upto[-1])
        offsets = lists.offsets.to_numpy()
        return pool[at], upto[offsets[1:] - offsets[0]]

    def encode(self, texts: list) -> list[bytes]:
        ids, ends = self.token_ids(pa.array(texts, pa.large_string()))
        return [x.tobytes() for x in np.split(ids, ends[:-1])] if texts else []


def encoder(path: str) -> WordEncoder:
    return C.one_model(("words", path), lambda: WordEncoder(path))


def blocks(batches):
    """Arrow batches (doc_id, text) joined or cut to tables of about
    ``BLOCK_BYTES`` of text: a word is looked up once a block. A longer text
    is a block by itself."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - size, "right")))
            held.append(batch.slice(first, last - first))
            size, first = size + int(ends[last - 1]) - before, last
            if size >= BLOCK_BYTES or first < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


# --- the file format ----------------------------------------------------------

@functools.lru_cache(maxsize=4)
def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


class ShardWriter:
    def __init__(self, dictionary: bytes, width: int = 2):
        self.width = width
        self.hash = hashlib.sha256(dictionary).digest()
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True,
                                            write_checksum=False, write_dict_id=False)
        self.frames, self.index = bytearray(), []

    def add(self, doc_id, ids: np.ndarray) -> None:
        raw = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        frame = self.zip.compress(raw)
        null = doc_id is None
        self.index.append((0 if null else doc_id, null, len(self.frames), len(frame), len(ids)))
        self.frames += frame

    def finish(self) -> bytes:
        """The shard without its last byte, the line end that the writer adds."""
        index = np.array(self.index, _INDEX).tobytes()
        size = len(self.frames) + len(index) + _FOOTER.size + len(MAGIC)
        foot = _FOOTER.pack(len(self.frames), len(self.index), self.width, self.hash, size)
        out = bytes(self.frames) + index + foot + MAGIC[:-1]
        self.frames, self.index = bytearray(), []
        return out


def shards(data: bytes):
    """(start, index, bytes per id, dictionary hash) of each shard of a file, first to last."""
    found, end = [], len(data)
    while end > 0:
        if data[end - len(MAGIC):end] != MAGIC:
            raise ValueError("not a token file, or cut short")
        at, n, width, digest, size = _FOOTER.unpack_from(data, end - len(MAGIC) - _FOOTER.size)
        start = end - size
        found.append((start, np.frombuffer(data, _INDEX, n, start + at), width, digest))
        end = start
    return reversed(found)


def read_frame(data: bytes, start: int, entry, width: int, unzip) -> np.ndarray:
    at = start + int(entry["at"])
    raw = unzip.decompress(data[at:at + int(entry["size"])], max_output_size=max(1, int(entry["ids"]) * width))
    return np.frombuffer(raw, "<u2" if width == 2 else "<u4")


def unzipper(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))


def fetch(data: bytes, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """Ids of one document of a file, opening its frame alone."""
    for start, index, width, digest in shards(data):
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        hit = np.flatnonzero((index["doc_id"] == doc_id) & (index["null"] == 0))
        if len(hit):
            return read_frame(data, start, index[hit[0]], width, unzipper(dictionary))
    return None


# --- Spark --------------------------------------------------------------------

def train_dictionary(docs: DataFrame, path: str, count: int) -> bytes:
    """Dictionary over the sample described above; ``count``: rows of the
    table. Empty when there is too little to train on."""
    sample = (docs.where(F.length("text").between(1, DICT_CHARS))
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, count))) < DICT_DOCS)
              .select("text").limit(2 * DICT_DOCS).collect())
    sample.sort()
    arrays = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in encoder(path).encode([r[0] for r in sample])]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1, sum(map(len, arrays)) // 8)), arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):   # too few or too small samples
        return b""


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 2,
          vocab: str = VOCAB, folder: str | None = None) -> None:
    """Encode whole texts and write the files below ``path`` in ascending
    doc_id order: ``path/ids`` (one file a range) and ``path/dictionary``.

    Null ids come first, rows that repeat an id lie in order of their text's
    hash; null and empty texts hold only the end id. Other columns are not
    read. An empty table gives no files of ids.
    """
    C.prepare(docs.sparkSession)
    vocab_path = C.tokenizer_file(vocab, folder)
    own = C.ids_only(docs, id_col, text_col)
    count, size = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()
    dictionary = train_dictionary(own, vocab_path, count)
    spark = docs.sparkSession
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").write.parquet(f"{path}/dictionary")
    parts = max(1, -(-size // FILE_TEXT_BYTES))
    ordered = (own.withColumn("tie", F.xxhash64("text")).repartitionByRange(int(parts), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))

    def run(batches):
        enc = encoder(vocab_path)
        out = ShardWriter(dictionary, 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4)
        for block in blocks(batches):
            ids, ends = enc.token_ids(block["text"].combine_chunks())
            if end_id is not None:
                ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            for doc_id, own in zip(block["doc_id"].to_pylist(), np.split(ids, ends[:-1]), strict=True):
                out.add(doc_id, own)
                if len(out.frames) >= SHARD_BYTES:
                    yield pa.record_batch({"shard": pa.array([out.finish()], pa.binary())})
        if out.index:
            yield pa.record_batch({"shard": pa.array([out.finish()], pa.binary())})
        C.give_back()

    ordered.mapInArrow(run, "shard binary").select(F.col("shard").cast("string")).write.text(f"{path}/ids")


def read(spark: SparkSession, path: str) -> DataFrame:
    """file_no, ord, doc_id, start, n_tokens, ids_crc32, token_ids of every
    document, read back from the files; start counts all ids before it."""
    C.prepare(spark)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").head()[0])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")

    def run(batches):
        C.free_model()
        unzip, digest = unzipper(dictionary), hashlib.sha256(dictionary).digest()
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                file_no, before, order = int(re.search(r"part-(\d+)", name.rsplit("/", 1)[1])[1]), 0, 0
                for start, index, width, found in shards(data):
                    if found != digest:
                        raise ValueError(f"{name}: written with another dictionary")
                    rows = []
                    for entry in index:
                        ids = read_frame(data, start, entry, width, unzip).astype("<u4").tobytes()
                        n = int(entry["ids"])
                        rows.append((file_no, order, None if entry["null"] else int(entry["doc_id"]), before, n,
                                     zlib.crc32(ids), ids))
                        before, order = before + n, order + 1
                    out = pd.DataFrame(rows, columns=["file_no", "ord", "doc_id", "before", "n_tokens", "ids_crc32", "token_ids"])
                    yield out.astype({"doc_id": "Int64"})

    rows = files.select("path", "content").mapInPandas(
        run, "file_no long, ord long, doc_id long, before long, n_tokens long, ids_crc32 long, token_ids binary")

    def totals(batches):
        for pdf in batches:
            yield pd.DataFrame([(int(re.search(r"part-(\d+)", name.rsplit("/", 1)[1])[1]),
                                 sum(int(index["ids"].sum()) for _, index, _, _ in shards(data)))
                                for name, data in zip(pdf["path"], pdf["content"], strict=True)], columns=["file_no", "ids"])

    # One row a file: the running sum is over files, not documents.
    sums = files.select("path", "content").mapInPandas(totals, "file_no long, ids long")
    base = sums.select("file_no", (F.sum("ids").over(Window.orderBy("file_no")) - F.col("ids")).alias("base"))
    return rows.join(base, "file_no").select("file_no", "ord", "doc_id", (F.col("base") + F.col("before")).alias("start"),
                                             "n_tokens", "ids_crc32", "token_ids")


def scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
