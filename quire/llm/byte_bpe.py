"""Byte-level BPE by public rank files, encoding and decoding.

A text is cut by the vocabulary's pattern; a piece that is itself in the
vocabulary is its own token. The other distinct pieces of a batch are laid
out as padded matrices, one per length bucket. In each round every row merges
its leftmost pair of minimum rank; ranks of pairs come from one open-addressed
hash table, a merge only looks up its two new neighbours, columns close up
behind it and finished rows leave the matrix. Pieces over ``LONG`` bytes
follow the same rule with a heap, as a matrix of one row would need a round
per merge.
"""

from __future__ import annotations

import base64
import heapq
from bisect import bisect_left

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from quire.llm import common as C

VOCAB = "byte_bpe_multi_50k.tiktoken"
LONG = 256
BUCKETS = (4, 6, 8, 12, 16, 24, 32, 64, 128, LONG)
MATRIX_CELLS = 1 << 18
CACHED_PIECES = 150_000
TEXT_CHARS = 1_000_000
NONE = np.int32(2 ** 31 - 1)


class PairTable:
    """(left id, right id) -> rank of the joined bytes, open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        lefts, rights, joined = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    lefts.append(a)
                    rights.append(b)
                    joined.append(rank)
        keys = self.key(np.array(lefts, np.int64), np.array(rights, np.int64))
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        todo, vals, slot = keys, np.array(joined, np.int32), self.slot(keys)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]       # of rivals for a slot the last one stays
            won = self.keys[slot] == todo
            self.vals[slot[won]] = vals[won]
            todo, vals, slot = todo[~won], vals[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def key(a, b):
        return (a.astype(np.int64) << 32) | b.astype(np.int64)

    def slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none or an id is negative (padding)."""
        keys = np.where((a < 0) | (b < 0), -2, self.key(a, b)).ravel()
        out = np.full(len(keys), NONE, np.int32)
        left = np.flatnonzero(keys >= 0)
        slot = self.slot(keys[left])
        while len(left):
            seen = self.keys[slot]
            hit = seen == keys[left]
            out[left[hit]] = self.vals[slot[hit]]
            on = ~hit & (seen >= 0)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(a.shape)


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    """Bytes of every id."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def joined(tokens: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str, cached: int | None = None):
        self.ranks = _ranks(path)
        self.token_bytes = _tokens(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.pieces_of = regex.compile(pattern).findall
        self.known: C.Recent = C.Recent(cached or CACHED_PIECES)     # piece -> ids

    def merge_rows(self, rows: list[bytes], width: int) -> list[bytes]:
        """Token ids of each row as little-endian unsigned 32-bit integers;
        rows have 1 to ``width`` bytes."""
        n = len(rows)
        lens = np.fromiter(map(len, rows), np.int64, n)
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
        which, done = np.arange(n), []
        while n:
            at = rank.argmin(axis=1)                 # leftmost of the smallest
            best = rank[np.arange(n), at]
            over = best == NONE
            if over.any():
                ended = ids[over]
                done.append((which[over], lens[over], ended[np.arange(ended.shape[1]) < lens[over][:, None]]))
                on = ~over
                ids, rank, lens, which, at, best = ids[on], rank[on], lens[on], which[on], at[on], best[on]
                n = len(which)
                if not n:
                    break
            width = ids.shape[1]
            r, cols = np.arange(n), np.arange(width - 1)
            ids[r, at] = best
            ids = np.where(cols <= at[:, None], ids[:, :-1], ids[:, 1:])
            rank = np.where(cols <= at[:, None], rank[:, :-1], rank[:, 1:])
            lens = lens - 1
            right = np.minimum(at + 1, width - 2)
            rank[r, at] = np.where(right > at, self.pairs(best, ids[r, right]), NONE)
            prev = np.maximum(at - 1, 0)
            has = at > 0
            rank[r[has], prev[has]] = self.pairs(ids[r[has], prev[has]], best[has])
        flat = np.concatenate([x for *_, x in done]).astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.concatenate([x for _, x, _ in done]))
        spans = map(slice, np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())
        out = [b""] * len(rows)
        for k, ids_ in zip(np.concatenate([x for x, *_ in done]).tolist(), map(flat.__getitem__, spans), strict=True):
            out[k] = ids_
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same rule over a linked list, smallest (rank, position) first."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pairs(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i), int(ids[i]), int(ids[i + 1])) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        ids = ids.tolist()
        n = len(ids)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        token, ranks = self.token_bytes, self.ranks
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (got := ranks.get(token[ids[x]] + token[ids[y]])) is not None:
                    heapq.heappush(heap, (got, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of the pieces into ``known``."""
        known, ranks = self.known, self.ranks
        by_width: list[tuple[list[str], list[bytes]]] = [([], []) for _ in BUCKETS]
        for p in known.missing(pieces):
            raw = p.encode("utf-8")
            whole = ranks.get(raw)
            if whole is not None:
                known[p] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                known[p] = self.merge_long(raw).astype("<u4").tobytes()
            else:
                names, raws = by_width[bisect_left(BUCKETS, len(raw))]
                names.append(p)
                raws.append(raw)
        for width, (names, raws) in zip(BUCKETS, by_width, strict=True):
            step = max(1, MATRIX_CELLS // width)
            for i in range(0, len(raws), step):
                known.update(zip(names[i:i + step], self.merge_rows(raws[i:i + step], width), strict=True))

    @C.no_gc()
    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            cut, size = [], 0
            while i < len(texts) and size < TEXT_CHARS:
                cut.append(self.pieces_of(texts[i] or ""))
                size += len(texts[i] or "")
                i += 1
            new = set()
            for pieces in cut:
                new.update(pieces)
            self.learn(new)
            out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        return out

    def decode(self, ids: bytes) -> bytes:
        return joined(self.token_bytes, ids)


def load(path: str, pattern: str) -> ByteBpe:
    """The worker's encoder."""
    return C.one_model(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def _parts(vocab: str, folder: str | None, pattern: str | None) -> tuple[str, str]:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return C.tokenizer_file(vocab, folder), pattern


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB,
           folder: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids (binary, little-endian unsigned 32-bit):
    one row per input row, whole texts, no special tokens.

    Null and empty texts have no tokens; a null doc_id stays null; repeated
    rows are encoded as they come; other columns are not read.
    """
    C.prepare(docs.sparkSession)
    path, pat = _parts(vocab, folder, pattern)

    def run(batches):
        bpe = load(path, pat)
        for pdf in batches:
            ids = bpe.encode(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "token_ids": ids})
        pdf = ids = None      # gone before the worker waits for its next task
        C.give_back()

    return C.ids_only(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_tokens long, token_ids binary")


def decode(encoded: DataFrame, vocab: str = VOCAB, folder: str | None = None, pattern: str | None = None) -> DataFrame:
    """The encoded rows with ``decoded``, the bytes of their tokens. A worker
    that decodes holds the tokens alone, none of the encoder's tables."""
    path, _ = _parts(vocab, folder, pattern)

    def run(batches):
        tokens = C.one_model(("byte_bpe tokens", path), lambda: _tokens(_ranks(path)))
        for pdf in batches:
            yield pdf.assign(decoded=[joined(tokens, x) for x in pdf["token_ids"]])

    return encoded.mapInPandas(run, "doc_id long, n_tokens long, token_ids binary, decoded binary")
