"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents long: a signature of a whole document would
share almost nothing with an item's. So items are partitioned by size (powers
of two of their shingle counts), and for each partition a document is cut into
blocks of that size and every two neighbouring blocks are one window. An
item's shingles then meet windows of a size like its own, however long the
document is. Block minima of a larger partition come from those of the
smaller one, so a document is hashed once. Any window that shares a minimum
with an item makes the pair a candidate, confirmed by the exact containment of
the item's shingle set in the document's whole set.

At containment 0.8 an item shares no minimum with the windows with a
probability of about exp(-0.16 * PERMS), 2e-9, whether its shingles stand
together or apart. That does not hold for items of fewer than ``FEW``
shingles, whose share of the smallest window is less: they are candidates of
every document that has one of their shingles, looked up as it is.

Documents are neither shuffled nor collected. Items go to the tasks in blocks
of at most ``BLOCK_SHINGLES`` shingles (about 30 MB); a larger benchmark takes
one pass over the documents per block.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C

PERMS, SEED = 128, 77
LEAST_SIZE = 16
FEW = 8
BLOCK_SHINGLES = 2_000_000
FILTER_BITS = 22
_LANE = np.uint64(32)


class ItemIndex:
    """Size partitions of one block of items."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        self.width = width
        self.perms = C.permutations(PERMS, SEED)
        self.ids, self.sets, self.short = [], [], {}
        parts: dict[int, list[tuple[int, np.ndarray]]] = {}
        few: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            h = C.word_hashes(C.words_of(text))
            if not len(h):
                continue
            s = np.unique(C.shingle_hashes(h, width))
            no = len(self.ids)
            self.ids.append(item_id)
            self.sets.append(s)
            if len(h) < width:          # one shingle of fewer words: looked up as it is
                self.short.setdefault(len(h), {}).setdefault(int(s[0]), []).append(no)
            elif len(s) < FEW:
                few.append((no, s))
            else:
                size = max(LEAST_SIZE, 1 << int(len(s) - 1).bit_length())
                parts.setdefault(size, []).append((no, C.minima((s >> _LANE).astype(np.uint32), self.perms)))
        self.parts = {size: self.table([(no, self.lanes(m)) for no, m in parts[size]]) for size in sorted(parts)}
        self.few = self.table(few) if few else None

    def table(self, entries: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, the item of each, and a filter of the keys."""
        keys = np.concatenate([k for _, k in entries])
        items = np.repeat(np.array([no for no, _ in entries], np.int64), [len(k) for _, k in entries])
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[self.slot(keys)] = True
        return keys[order], items[order], seen

    def hits(self, table, values: np.ndarray) -> set[int]:
        """Items of the table that have one of the values."""
        keys, items, seen = table
        values = np.unique(values[seen[self.slot(values)]])
        found: set[int] = set()
        for i, j in zip(np.searchsorted(keys, values), np.searchsorted(keys, values, "right"), strict=True):
            found.update(items[i:j].tolist())
        return found

    @staticmethod
    def lanes(m: np.ndarray) -> np.ndarray:
        """Minima with their permutation's number in the high half."""
        number = np.arange(PERMS, dtype=np.uint64) << _LANE
        return (m.astype(np.uint64).T + number).T if m.ndim > 1 else m.astype(np.uint64) + number

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def block_minima(self, values: np.ndarray) -> np.ndarray:
        """(PERMS, blocks): minima of blocks of LEAST_SIZE consecutive shingles."""
        a, b = self.perms
        out = []
        for i in range(0, len(values), 4096):
            v = values[i:i + 4096]
            out.append(np.minimum.reduceat(a[:, None] * v[None, :] + b[:, None], np.arange(0, len(v), LEAST_SIZE), axis=1))
        return np.concatenate(out, axis=1)

    def candidates(self, shingles: np.ndarray) -> set[int]:
        found = self.hits(self.few, shingles) if self.few else set()
        if not self.parts:
            return found
        blocks, size = self.block_minima((shingles >> _LANE).astype(np.uint32)), LEAST_SIZE
        last = max(self.parts)
        while True:
            if size in self.parts:
                windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
                found |= self.hits(self.parts[size], self.lanes(windows).ravel())
            if size == last:
                return found
            if blocks.shape[1] > 1:
                blocks = np.minimum.reduceat(blocks, np.arange(0, blocks.shape[1], 2), axis=1)
            size *= 2

    def contained(self, text, percent: int) -> list[tuple[int, int, int]]:
        """(item id, shingles of the item, of them in the text), exact."""
        h = C.word_hashes(C.words_of(text))
        if not len(h):
            return []
        out = []
        for words, table in self.short.items():
            if len(h) >= words:
                for s in np.unique(C.shingle_hashes(h, words)).tolist():
                    out += [(self.ids[no], 1, 1) for no in table.get(s, ())]
        shingles = C.shingle_hashes(h, self.width)
        found = self.candidates(shingles) if len(h) >= self.width else set()
        if found:
            whole = np.unique(shingles)
            for no in sorted(found):
                s = self.sets[no]
                n = int(np.isin(s, whole, assume_unique=True).sum())
                if 100 * n >= percent * len(s):
                    out.append((self.ids[no], len(s), n))
        return out


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, n_item, n_found, containment: every pair in which the
    document holds at least ``percent`` of the item's distinct ``width``-word
    shingles, once.

    Words as in near_dedup. An item of fewer words than ``width`` is held by a
    document that has its whole word sequence. Null, empty and blank texts
    hold nothing and are held by nothing. Repeated documents give their pairs
    once; items that share an id are compared one by one and their pair with
    the most shingles found stays; null ids are kept as null. Other columns
    are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    C.prepare(spark)
    own, kind = C.ids_only(docs, id_col, text_col), C.id_type(id_col)
    tests = items.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    size = tests.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, -(-size // (2 * BLOCK_SHINGLES)))       # a word and its blank take two bytes at least
    out = None
    for k in range(int(blocks)):
        part = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(int(blocks))) == k) if blocks > 1 else tests
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in part.toLocalIterator()])
        found = own.mapInPandas(_search(shared, width, percent, kind), f"doc_id {kind}, item_id long, n_item long, n_found long")
        out = found if out is None else out.union(found)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_found", "n_item")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n_item").alias("n_item"), F.col("b.n_found").alias("n_found"),
                       (F.col("b.n_found") / F.col("b.n_item")).alias("containment"))


def _index(shared, width: int) -> ItemIndex:
    """The index of a broadcast block, built once in a worker process."""
    return C.one_model(("items", hash(tuple(shared.value)), width), lambda: ItemIndex(shared.value, width))


def _search(shared, width: int, percent: int, kind: str = "long"):
    def run(batches):
        C.free_model()
        index = _index(shared, width)
        for pdf in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True)
                    for hit in index.contained(text, percent)]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_item", "n_found"])
            yield out.astype({"item_id": "Int64"} | ({"doc_id": "Int64"} if kind == "long" else {}))
        pdf = out = None      # gone before the worker waits for its next task
        C.give_back()
    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      width: int = 5, percent: int = 80, by_row: bool = False) -> DataFrame:
    """``docs`` without the documents that hold a test item; all columns as
    they were. A doc_id goes with all its rows, rows without id stay; with
    ``by_row`` the rows whose own text holds an item go, with or without id."""
    if by_row:
        return C.by_row(docs, id_col, text_col, lambda d, key: drop_contaminated(d, items, key, text_col, width, percent))
    found = C.stored(contained_items(docs, items, id_col, text_col, width=width, percent=percent), "decontaminate")
    return C.without_ids(docs, id_col, found.where("doc_id IS NOT NULL").select("doc_id").distinct())
