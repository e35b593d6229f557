"""Global line dedup over content-defined chunks, grown to whole passages.

A text's lines are hashed; a rolling hash over the last two line hashes sets a
boundary where it is divisible by ``PERIOD`` and the one before it is not, so
that chunks have two lines at least, boundaries depend on the lines around
them alone and an insertion shifts only its own chunk. A line of
``LONG_WORDS`` words or more is a whole passage and a chunk by itself. Chunks
with two lines that hold words, and such long lines, may be removed, however
few words they have; single short lines stay, however common.

Chunks that occur more than once in the whole corpus go first. A boundary may
cut a repeated passage anywhere, so every repeat is then grown to both of its
ends: each two neighbouring lines with words (and the blank lines between
them) that do not lie in a removed chunk are a unit of their own, and so runs
that hold no whole chunk are found as well. A line goes when a repeated unit
covers it, so a repeated passage goes from its first line to its last,
whatever stands around it.

Of each unit the first occurrence (smallest doc_id, then text hash and place)
stays. Hashes only find the candidates: every removal has been compared byte
by byte with the occurrence that stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind
from quire.llm import common as C
from quire.session import bounded_broadcast

PERIOD = 2
LONG_WORDS = 50
BLANKS = " \t\n\x0b\x0c\r"
# Rows of a join side that may be broadcast (its bytes are measured as well).
BROADCAST_ROWS = 2_000_000
# Items of lists (20 to 40 bytes each) that may be broadcast, and bytes of text worked on at once.
BROADCAST_ITEMS, BATCH_BYTES = 1_000_000, 4 << 20
_UNIT = "doc_id long, thash binary, pos int, lines int, key long"


def _marks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every line of the texts, one text after another: its hash, whether
    it holds a word, whether it is long, its text; and every text's first line."""
    data, bounds = C.utf8_of(texts)
    n = len(bounds) - 1
    at = np.flatnonzero(data == 10)
    stops = np.diff(np.searchsorted(at, bounds)) + 1           # lines of every text
    last = np.cumsum(stops) - 1
    first = last - stops + 1
    start, end = np.empty(len(at) + n, np.int64), np.empty(len(at) + n, np.int64)
    inner = np.ones(len(start), bool)
    inner[first] = False
    start[first], start[inner] = bounds[:-1], at + 1
    inner[first], inner[last] = True, False
    end[last], end[inner] = bounds[1:], at
    raw = memoryview(data)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))
    # a word starts behind a blank or with its text
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = bounds[:-1][np.diff(bounds) > 0]
    begins[edge] = inside[edge]
    begins = np.flatnonzero(begins)
    count = np.searchsorted(begins, end) - np.searchsorted(begins, start)
    return hashes, count > 0, count >= LONG_WORDS, np.repeat(np.arange(n), stops), first


_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))


def _chunks(marks) -> tuple[np.ndarray, np.ndarray]:
    """First line (among all lines of ``marks``) and number of lines of every
    removable chunk, without the blank lines at its ends."""
    hashes, words, long, _, first = marks
    opens = np.zeros(len(hashes), bool)
    opens[first] = True
    before = np.concatenate((hashes[:0], [np.uint64(0)], hashes[:-1]))[:len(hashes)]
    before[first] = 0
    hit = C.mix64(before * np.uint64(31) + hashes) % np.uint64(PERIOD) == 0
    ends = hit & ~(np.concatenate(([False], hit[:-1])) & ~opens)
    ends |= long | np.concatenate((long[1:], [False])) | np.concatenate((opens[1:], [True]))
    at = np.flatnonzero(words)
    chunk = (np.cumsum(ends) - ends)[at]
    lead = np.flatnonzero(np.diff(chunk, prepend=-1))
    size = np.diff(lead, append=len(at))
    lead, size = (x[(size >= 2) | long[at[lead]]] for x in (lead, size))
    return at[lead], at[lead + size - 1] - at[lead] + 1


def _pairs(marks, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of every two neighbouring lines with
    words, and of every long line, but for those inside one of the removed
    chunks, which are given in the same way."""
    _, words, long, doc, _ = marks
    at = np.flatnonzero(words)
    chunk = np.zeros(len(words), np.int64)
    chunk[C.ranges(start, size)] = np.repeat(np.arange(1, len(start) + 1), size)
    i, j = at[:-1], at[1:]
    two = (doc[i] == doc[j]) & ~((chunk[i] > 0) & (chunk[i] == chunk[j]))
    alone = np.flatnonzero(long & (chunk == 0))
    return np.concatenate((i[two], alone)), np.concatenate(((j - i)[two] + 1, np.ones(len(alone), np.int64)))


def chunks(lines: list[str]) -> list[tuple[int, int]]:
    """(first line, number of lines) of every removable chunk of one text."""
    start, size = _chunks(_marks(pa.array(["\n".join(lines)])))
    return list(zip(start.tolist(), size.tolist(), strict=True))


def _keys(hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of every unit from those of its lines and their order."""
    if not len(start):
        return np.empty(0, np.int64)
    lead = np.cumsum(size) - size
    place = (np.arange(int(size.sum())) - np.repeat(lead, size)).astype(np.uint64)
    mixed = C.mix64(hashes[C.ranges(start, size)] + place * np.uint64(0x9E3779B97F4A7C15))
    return C.mix64(np.add.reduceat(mixed, lead) + size.astype(np.uint64)).view(np.int64)


def _unit_rows(own: DataFrame, grown: bool) -> DataFrame:
    """One row per unit of every text: (doc_id, thash, pos, lines, key)."""
    def run(batches):
        C.free_model()
        batch = part = None
        for batch in batches:
            for part in C.byte_slices(batch, "text", BATCH_BYTES):
                yield units(part)
        del batch, part       # gone before the worker waits for its next task
        C.give_back()

    def units(part):
        marks = _marks(part.column("text"))
        hashes, *_, doc, first = marks
        if grown:
            gone = part.column("gone")
            place = pc.list_flatten(gone)
            owner = pc.list_parent_indices(gone).to_numpy(zero_copy_only=False)
            pos, size = (place.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pos", "lines"))
            start, size = _pairs(marks, first[owner] + pos, size)
        else:
            start, size = _chunks(marks)
        of = doc[start]
        take = pa.array(of)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(take), part.column("thash").take(take), pa.array((start - first[of]).astype(np.int32)),
             pa.array(size.astype(np.int32)), pa.array(_keys(hashes, start, size))], names=["doc_id", "thash", "pos", "lines", "key"])

    return own.mapInArrow(run, _UNIT)


def _repeated(own: DataFrame, grown: bool) -> DataFrame:
    """(doc_id, thash, pos, lines, first): units that repeat an earlier one, byte by byte."""
    at = F.struct("doc_id", "thash", "pos")
    name = "grown" if grown else "chunk"
    # (1) places and keys of all units, without their bodies; keys alone are shuffled
    units = C.stored(_unit_rows(own, grown), f"line-{name}-units")
    twice = C.stored(units.groupBy("key").count().where("count > 1").select("key"), f"line-{name}-keys")
    keys, _ = bounded_broadcast(twice, BROADCAST_ROWS)
    again = C.stored(units.join(keys, "key").distinct(), f"line-{name}-again")
    common = C.stored(again.groupBy("key").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select("key", "first"),
                      f"line-{name}-first")
    firsts, _ = bounded_broadcast(common, BROADCAST_ROWS)
    # (2) bodies of repeated units only, cut from the texts that hold one
    wanted = again.join(firsts, "key").select("doc_id", "thash", F.struct("pos", "lines", "key", at.eqNullSafe(F.col("first")).alias("stays")).alias("u"))
    wanted = C.stored(wanted.groupBy("doc_id", "thash").agg(F.collect_list("u").alias("u")), f"line-{name}-wanted")
    cut = bind(F.split("text", "\n", -1), lambda lines: F.transform("u", lambda u: F.struct(
        u["pos"].alias("pos"), u["lines"].alias("lines"), u["key"].alias("key"), u["stays"].alias("stays"),
        F.array_join(F.slice(lines, u["pos"] + 1, u["lines"]), "\n").alias("body"))))
    rows = C.stored(_with(own.select("doc_id", "thash", "text"), wanted, "u", "inner").select("doc_id", "thash", F.inline(cut)), f"line-{name}-bodies")
    stays = rows.where("stays").select("key", F.col("body").alias("kept_body"), at.alias("first")).distinct()
    return rows.where("NOT stays").join(stays, "key").where("body = kept_body").select("doc_id", "thash", "pos", "lines", "first").distinct()


def _with(rows: DataFrame, lists: DataFrame, name: str = "gone", how: str = "left") -> DataFrame:
    """Rows (doc_id, thash, text) with the list of that name of their document;
    null without. The lists are broadcast only if their items are few."""
    items = lists.agg(F.coalesce(F.sum(F.size(name)), F.lit(0))).head()[0]
    small = F.broadcast(lists) if items <= min(BROADCAST_ROWS, BROADCAST_ITEMS) else lists
    small = small.withColumnsRenamed({"doc_id": "_i", "thash": "_h"})
    return rows.join(small, rows["doc_id"].eqNullSafe(small["_i"]) & (rows["thash"] == small["_h"]), how).drop("_i", "_h")


def repeated_lines(own: DataFrame) -> DataFrame:
    """(doc_id, thash, gone): the places of the lines of a text that repeat an
    earlier passage, for ``own`` (doc_id, thash, text)."""
    none = F.lit(None).cast("array<struct<pos:int,lines:int>>").alias("gone")
    first = C.stored(_repeated(own.select("*", none), False), "line-chunks")
    removed = C.stored(first.groupBy("doc_id", "thash").agg(F.collect_set(F.struct("pos", "lines")).alias("gone")), "line-removed")
    more = C.stored(_repeated(_with(own, removed), True), "line-grown")
    found = first.unionByName(more)
    # a unit that overlaps the one that stays loses only what lies behind it
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("thash") == F.col("first.thash"))
    start = F.when(same, F.greatest("pos", F.col("first.pos") + F.col("lines"))).otherwise(F.col("pos"))
    return (found.select("doc_id", "thash", F.explode(F.sequence(start, F.col("pos") + F.col("lines") - 1)).alias("i"))
            .groupBy("doc_id", "thash").agg(F.array_sort(F.collect_set("i")).alias("gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with repeated passages cut out of the text column, and with
    ``counts`` three more: n_lines, n_runs_removed (runs of removed lines),
    n_lines_removed (input columns of these names give way to them).

    Every row stays; a text whose passages all stand elsewhere becomes empty.
    Single short lines stay, and so do blank lines at the ends of a passage.
    Null texts stay null with zero counts, empty and blank texts as they are.
    Rows that repeat id and text are one document and get one result; rows
    that repeat an id with other texts are told apart by their text. Null ids
    order first. The other columns, whatever their names, pass unread.
    """
    C.prepare(docs.sparkSession)
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    thash = F.unhex(F.md5(text))
    own = docs.select(doc_id.alias("doc_id"), thash.alias("thash"), text.alias("text"))
    gone = C.stored(repeated_lines(own), "line-removals")
    # all input columns travel as one struct, so no name of theirs can clash
    out = _with(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_id.alias("doc_id"), thash.alias("thash"),
                            text.alias("text")), gone)
    cut = F.when(F.col("gone").isNotNull(), bind(F.split("text", "\n", -1), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone"), lambda i: F.element_at(lines, i + 1)), "\n")))
    runs = F.size(F.filter("gone", lambda x, k: (k == 0) | (F.get("gone", k - 1) != x - 1)))
    more = {"n_lines": F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)), "n_runs_removed": F.coalesce(runs, F.lit(0)),
            "n_lines_removed": F.coalesce(F.size("gone"), F.lit(0))} if counts else {}
    made = out.select("row", F.struct(F.coalesce(cut, "text").alias("text"), *[c.cast("long").alias(name) for name, c in more.items()]).alias("made"))
    return made.select(*[(F.col("made.text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in more],
                       *[F.col(f"made.{name}").alias(name) for name in more])
