"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir, ship_package

# Rows of one Arrow batch: texts of 100 kB and more must not pile up in a worker.
ARROW_ROWS = 512
# A key set of at most this many rows (16 bytes each) may be broadcast.
BROADCAST_KEYS = 1_000_000
# The column of row keys (``by_row``) starts so; a key is 50 bytes long, so fewer are broadcast.
ROW = "__row_key"
BROADCAST_ROW_KEYS = 200_000


def prepare(spark: SparkSession) -> None:
    """Settings the Python operators rely on; safe to call again."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ids_only(docs: DataFrame, id_col: str, *cols: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names: other columns of
    the input, whatever they are called, cannot clash with its own."""
    return docs.select(F.col(f"`{id_col}`").cast(id_type(id_col)).alias("doc_id"),
                       *[F.col(f"`{c}`").alias(a) for c, a in zip(cols, ("text", "lang"), strict=False)])


def small(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """``keys`` (a few short columns) with a broadcast hint if it is counted to
    at most ``rows`` (``BROADCAST_KEYS``) rows; beyond that Spark joins by shuffle."""
    rows = BROADCAST_KEYS if rows is None else rows
    return F.broadcast(keys) if keys.limit(rows + 1).count() <= rows else keys


def without_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one column ``doc_id``, no
    repeats). The ids are broadcast only when counted to at most
    ``BROADCAST_KEYS``; beyond that Spark joins by shuffle. Null ids stay."""
    gone = small(ids.select(F.col("doc_id").alias("_gone")), BROADCAST_ROW_KEYS if id_col.startswith(ROW) else None)
    return docs.join(gone, docs[f"`{id_col}`"].cast(id_type(id_col)) == gone["_gone"], "left_anti")


def id_type(id_col: str) -> str:
    return "string" if id_col.startswith(ROW) else "long"


def row_key(id_col: str, text_col: str):
    """Id and MD5 of the text as one string that is never null. Keys sort like
    the ids, null ids last."""
    number = F.col(f"`{id_col}`").cast("long").bitwiseXOR(F.lit(-2 ** 63).cast("long"))
    return F.concat(F.coalesce(F.lpad(F.hex(number), 16, "0"), F.lit("~")), F.lit(":"), F.coalesce(F.md5(f"`{text_col}`"), F.lit("")))


def by_row(docs: DataFrame, id_col: str, text_col: str, drop) -> DataFrame:
    """``drop(docs, key column)`` with row keys in place of ids: rows without
    id are judged like all others, and of an id with several texts only the
    rows whose own text is to go. The key's column has a name of its own, so
    that no input column can be lost."""
    key = f"{ROW}_{uuid.uuid4().hex}"
    return drop(docs.withColumn(key, row_key(id_col, text_col)), key).drop(key)


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` (column ``doc_id``) whose id is in ``ids``; broadcast rule as above."""
    rows = BROADCAST_ROW_KEYS if dict(ids.dtypes)["doc_id"] == "string" else None
    return docs.join(small(ids, rows), "doc_id", "left_semi")


@contextlib.contextmanager
def no_gc():
    """Cycle collection off for one batch of work that makes many lists and no
    cycles; it would walk the caches again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_MODEL: dict = {}


def one_model(key: tuple, build):
    """The worker process's model under ``key``, built on first use. Workers
    are used again by later stages, so a new model takes the old one's place."""
    if key not in _MODEL:
        free_model()
        _MODEL[key] = build()
    return _MODEL[key]


def free_model() -> None:
    """Lets go of a model that an earlier stage left in this worker process;
    called by operators that keep none of their own."""
    if _MODEL:
        _MODEL.clear()
        give_back()


def give_back() -> None:
    """Returns the memory that this worker process holds free to the system.
    Workers wait for later tasks beside a busy JVM, and neither Arrow's pool
    nor the C library lets go of it by itself."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Recent(dict):
    """A cache of at most ``2 * limit`` entries in two generations: when the
    young one is full it becomes the old one, and what is used again moves
    back. Frequent entries stay, memory is bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, keys: set) -> list:
        """Keys to be computed; the others are in the young generation afterwards."""
        if len(self) + len(keys) > self.limit:
            self.old = dict(self)
            self.clear()
        old, new = self.old, []
        for k in keys:
            if k not in self:
                if k in old:
                    self[k] = old[k]
                else:
                    new.append(k)
        return new


# --- batches of texts ---------------------------------------------------------

def byte_slices(batch: pa.RecordBatch, col: str, most: int):
    """The batch in slices of whole rows whose texts hold about ``most`` bytes."""
    _, bounds = utf8_of(batch.column(col))
    cuts = np.flatnonzero(np.diff((bounds[:-1] - bounds[0]) // most)) + 1 if len(bounds) > 1 else []
    for i, j in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(int(i), int(j - i))


def utf8_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts one after another and their bounds; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    return np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)


# --- words and shingles -------------------------------------------------------

def words_of(text) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased. Both
    bytes.lower and bytes.split know ASCII only, which is the rule's class."""
    return text.encode("utf-8", "replace").lower().split() if text else []


_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every ``width``-word shingle, in order of position; of
    the whole sequence when it is shorter; empty without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    w = min(width, n)
    acc = hashes[:n - w + 1].copy()
    for k in range(1, w):
        acc = acc * _MULT + hashes[k:n - w + 1 + k]
    return mix64(acc + np.uint64(w))


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``count`` permutations of 32-bit values."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2 ** 32, count, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 2 ** 32, count, dtype=np.uint32)


def minima(values: np.ndarray, perms: tuple[np.ndarray, np.ndarray], block: int = 4096) -> np.ndarray:
    """The smallest image of the 32-bit ``values`` under each permutation;
    blocks keep the matrix small for very long texts."""
    a, b = perms
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(values), block):
        v = values[i:i + block]
        np.minimum(out, (a[:, None] * v[None, :] + b[:, None]).min(axis=1), out=out)
    return out


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file: in ``folder``, or where the
    ``public_tokenizers`` package of the cluster image keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
