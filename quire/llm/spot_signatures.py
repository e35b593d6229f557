"""SpotSigs fingerprints: chains of content words that follow common words.

Anchors are the commonest words, counted over all documents: the
``ANCHORS`` words that stand in most documents of the corpus, and of every
language label that holds at least one document in ``LABEL_SHARE``. All other
words are content words. At every anchor the next ``CHAIN`` content words,
``SPACING`` apart, make one signature together with the anchor; a text without
a whole chain has its word sequence as its only signature. The fingerprint is
the sorted set of signatures, eight hexadecimal digits each.

Fingerprints are compared through pruned Jaccard: they belong to length
partitions whose bounds grow by 1 / threshold, so that a pair can only reach
the threshold inside one partition or two neighbouring ones, and a comparison
stops as soon as the signatures left cannot reach it any more.

The next document of the query comes from range buckets over the ids: each
bucket also gets the first document of the bucket after it, so the order is
never gathered into one task.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import chain, filterfalse, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C
from quire.llm import near_dedup

ANCHORS, LABEL_SHARE = 24, 100
CHAIN, SPACING = 3, 1
STRIPPED = ".,;:!?"
DIGITS = 8
BUCKET_BYTES, MOST_BUCKETS = 2 << 20, 50_000
FLUSH_WORDS = 100_000


def words_of(text) -> list[bytes]:
    """Words of the text in lower case (A-Z) without the marks at their end."""
    return list(filter(None, map(bytes.rstrip, C.words_of(text), repeat(STRIPPED.encode()))))


# --- anchors ------------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """(label, word, n): documents of every label (null: empty) that hold the
    word; under the empty word, all documents of the label."""
    def rows(seen):
        sizes = list(map(len, seen.values()))
        words = pa.array(list(chain.from_iterable(seen.values())), pa.binary())
        counts = list(chain.from_iterable(c.values() for c in seen.values()))
        labels = pa.array(list(seen), pa.string()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        return pa.RecordBatch.from_arrays([labels, words.cast(pa.string()), pa.array(counts, pa.int64())], names=["label", "word", "n"])

    def run(batches):
        seen: dict[str, Counter] = defaultdict(Counter)
        held = 0
        for batch in batches:
            for label, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = seen[label or ""]
                held -= len(own)
                own[b""] += 1
                own.update(set(words_of(text)))
                held += len(own)
                if held > FLUSH_WORDS:
                    yield rows(seen)
                    seen.clear()
                    held = 0
        yield rows(seen)

    return docs.select("lang", "text").mapInArrow(run, "label string, word string, n long").groupBy("label", "word").agg(F.sum("n").alias("n"))


def anchor_words(docs: DataFrame) -> list[str]:
    """The anchors of the corpus, sorted; at most ``ANCHORS * (LABEL_SHARE + 1)``."""
    counts = C.stored(word_counts(docs), "spots-words")
    sizes = {r["label"]: r["n"] for r in counts.where("word = ''").orderBy(F.desc("n"), "label").limit(LABEL_SHARE).collect()}
    total = counts.where("word = ''").agg(F.sum("n")).head()[0] or 0
    large = [a for a, n in sizes.items() if n * LABEL_SHARE >= total]
    words = counts.where("word <> ''")
    best = [F.desc("n"), F.asc("word")]
    found = {r["word"] for r in words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(*best).limit(ANCHORS).collect()}
    for label in large:
        found |= {r["word"] for r in words.where(F.col("label") == label).orderBy(*best).limit(ANCHORS).collect()}
    return sorted(found)


# --- fingerprints -------------------------------------------------------------

def spots(text, anchors: frozenset) -> set[bytes]:
    """The chains of a text, each behind its anchor; its word sequence if there is none."""
    words = words_of(text)
    if not words:
        return set()
    content = list(filterfalse(anchors.__contains__, words))
    at = np.flatnonzero(np.fromiter(map(anchors.__contains__, words), bool, len(words)))
    following = list(zip(*[content[i * SPACING:] for i in range(CHAIN)], strict=False))
    before = at - np.arange(len(at))                  # content words ahead of the anchor
    before = before[:np.searchsorted(before, len(following))]
    found = {b" ".join((words[i], *following[k])) for i, k in zip(at.tolist(), before.tolist(), strict=False)}
    return found or {b" ".join(words)}


def digests(found: set[bytes], known: dict[bytes, bytes] | None = None) -> dict[bytes, bytes]:
    """Signature of every spot; those in ``known`` are taken from there."""
    md5, size = hashlib.md5, DIGITS // 2
    new = found.difference(known) if known else found
    out = {s: known[s] for s in found.difference(new)} if known else {}
    out.update({s: md5(s).digest()[:size] for s in new})
    return out


def signatures(text, anchors: frozenset) -> list[str]:
    """Sorted distinct signatures of a text; none without words."""
    return [s.hex() for s in sorted(set(digests(spots(text, anchors)).values()))]


def length_partition(size: int, percent: int) -> int:
    """Number of the length partition of a set: partition k ends where
    ``percent`` of the next one's smallest size is reached."""
    k, low = 0, 1
    while size > (high := low * 100 // percent):
        k, low = k + 1, high + 1
    return k


def pruned_jaccard(a: list, b: list, percent: int = 0) -> float:
    """Jaccard similarity of two sorted signature lists; 0.0 as soon as it is
    clear that ``percent`` is not reached. Two empty sets are alike."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    total, need = len(a) + len(b), 0
    if percent:
        if 100 * len(a) < percent * len(b):
            return 0.0
        need = -(-percent * total // (100 + percent))
    if not need:
        common = len(set(a).intersection(b))
        return common / (total - common)
    inside, missed, common = set(b), 0, 0
    for s in a:
        if s in inside:
            common += 1
        else:
            missed += 1
            if len(a) - missed < need:
                return 0.0
    return common / (total - common)


def split(fingerprint: str) -> list[str]:
    return [fingerprint[i:i + DIGITS] for i in range(0, len(fingerprint), DIGITS)]


def fingerprints(docs: DataFrame, anchors: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, n_signatures: one row per input row."""
    C.prepare(docs.sparkSession)
    known = frozenset(w.encode() for w in anchors)

    def run(batches):
        for pdf in batches:
            sets = [signatures(t, known) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fingerprint": ["".join(s) for s in sets],
                                "n_signatures": [len(s) for s in sets]})

    return C.ids_only(docs, id_col, text_col).mapInPandas(run, "doc_id long, fingerprint string, n_signatures long")


# --- near duplicates ------------------------------------------------------------

def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """(node, bytes, key, pri): the buckets of every class. A set of n
    signatures is entered under its rarest ones only, as many as two sets that
    reach the threshold must share one of: in its own length partition, and in
    the next one, whose sets may still be long enough."""
    @F.pandas_udf("int")
    def partition(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda n: length_partition(int(n), percent)).astype("int32")

    rows = classes.select("node", "n", partition("n").alias("part"), F.explode("sigs").alias("sig"))
    counts = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = (rows.join(counts, "sig").groupBy("node", "n", "part").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s")))
    needed = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    keys = ranked.select("node", "n", "part", F.explode(F.slice("s", 1, needed)).alias("x"))
    keys = keys.select("node", "n", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("x.sig").alias("sig"))
    return keys.select("node", (F.col("n") * 8).cast("long").alias("bytes"), F.xxhash64("part", "sig").alias("key"), F.xxhash64("node").alias("pri"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", percent: int = 80,
                    anchors: list[str] | None = None) -> DataFrame:
    """doc_id, n_signatures, component_id, kept: one row per input row.

    Documents are linked when their fingerprints' Jaccard similarity reaches
    ``percent``; component_id is the smallest id reachable, kept marks that
    document. Texts without words have no signatures, are linked with nothing
    and stay. Equal fingerprints are one class; buckets are compared with
    pivots and in blocks, never all with all. Null ids take the component of
    their class. Other columns are not read."""
    C.prepare(docs.sparkSession)
    if anchors is None:
        lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
        anchors = anchor_words(docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text")))
    prints = C.stored(fingerprints(docs, anchors, id_col, text_col), "spots-prints")
    classes = (prints.where("n_signatures > 0 AND doc_id IS NOT NULL").groupBy("fingerprint")
               .agg(F.min("doc_id").alias("node"), F.first("n_signatures").cast("int").alias("n")))
    sigs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("fingerprint", i * DIGITS + 1, F.lit(DIGITS)))
    classes = C.stored(classes.withColumn("sigs", sigs), "spots-classes")
    members = C.stored(_shared(_candidates(classes, percent)), "spots-members")
    sets = classes.select("node", "fingerprint")

    def alike(x, y):
        return pruned_jaccard(split(x), split(y), percent) * 100 >= percent

    def verify(pairs):
        def run(batches):
            for pdf in batches:
                keep = [alike(x, y) for x, y in zip(pdf["x"], pdf["y"], strict=True)]
                yield pdf.loc[keep, ["a", "b"]]

        full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("fingerprint").alias("x")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("fingerprint").alias("y")), "b"))
        return full.mapInPandas(run, "a long, b long")

    def in_blocks(opened):
        def run(pdf):
            i, j = pdf["i"].iat[0], pdf["j"].iat[0]
            left, right = pdf[pdf["blk"] == i], pdf[pdf["blk"] == j]
            comp, out = dict(zip(pdf["node"], pdf["comp"], strict=True)), []
            for a, x in zip(left["node"], left["fingerprint"], strict=True):
                for b, y in zip(right["node"], right["fingerprint"], strict=True):
                    if comp[a] != comp[b] and alike(x, y):
                        out.append((a, b))
                        old, new = comp[b], comp[a]
                        comp.update({n: new for n, c in comp.items() if c == old})
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

        return near_dedup.dealt(opened).join(sets, "node").groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()

    comps = near_dedup.linked(members, verify, in_blocks)
    of_class = classes.select("fingerprint", F.col("node").alias("component_id")) if comps is None else (
        classes.join(comps, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id")))
    out = prints.join(of_class, "fingerprint", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n_signatures"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _shared(rows: DataFrame) -> DataFrame:
    """Bucket rows whose bucket holds more than one class."""
    several = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    return rows.join(several, "key", "left_semi")


# --- the next document --------------------------------------------------------

def _bucketed(own: DataFrame) -> tuple[DataFrame, int]:
    """``own`` with its range bucket (falling ids, null ids last). Bounds that
    fall on one id split its rows by the hash of their texts."""
    n, size = own.agg(F.count("doc_id"), F.sum(F.octet_length("text"))).head()
    count = max(1, min(MOST_BUCKETS, -(-(size or 0) // BUCKET_BYTES), n or 1))
    cuts = own.agg(F.percentile_approx("doc_id", [k / count for k in range(1, count)], max(10_000, 20 * count))).head()[0] if n and count > 1 else []
    bounds = np.sort(np.asarray(cuts or [], np.int64))

    @F.pandas_udf("long")
    def bucket(ids: pd.Series, h: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        i = ids.fillna(0).to_numpy().astype(np.int64)
        left, right = np.searchsorted(bounds, i, "left"), np.searchsorted(bounds, i, "right")
        share = ((h.to_numpy().astype(np.int64) >> 32) + 2 ** 31).astype(np.uint64)
        inner = left + ((share * (right - left + 1).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        return pd.Series(np.where(known, len(bounds) - np.where(left == right, left, inner), len(bounds) + 1))

    return own.withColumn("h", F.xxhash64("text")).withColumn("bucket", bucket("doc_id", "h")), count


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, guest, doc_id, h, text), partitioned and sorted so that every
    document is followed by the next one; a bucket ends with a guest row, the
    first document of the next bucket that is not empty (after the last: the first)."""
    own = C.ids_only(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows, _ = _bucketed(own)
    first = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")
    heads = rows.groupBy("bucket").agg(F.max(first).alias("first")).orderBy("bucket").collect()
    spark = docs.sparkSession
    ahead = [(a["bucket"], b["bucket"], b["first"]["doc_id"], b["first"]["h"]) for a, b in zip(heads, heads[1:] + heads[:1], strict=True)]
    guests = F.broadcast(spark.createDataFrame(ahead, "to long, at long, i long, k long"))
    guest = (rows.join(guests, (rows["bucket"] == guests["at"]) & rows["doc_id"].eqNullSafe(guests["i"]) & (rows["h"] == guests["k"]))
             .groupBy("to").agg(F.max(F.struct("doc_id", "h", "text")).alias("g"))
             .select(F.col("to").alias("bucket"), F.lit(True).alias("guest"), "g.doc_id", "g.h", "g.text"))
    both = rows.select("bucket", F.lit(False).alias("guest"), "doc_id", "h", "text").unionByName(guest)
    return both.repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), F.desc("h"))


def _edits(batches, known: frozenset):
    """Streams sorted rows; a row is complete once the next one is there. Most
    spots of an edited text stand in one of the two texts it is made from."""
    last = None
    for pdf in batches:
        out = []
        for bucket, guest, doc_id, text in zip(pdf["bucket"], pdf["guest"], pdf["doc_id"], pdf["text"], strict=True):
            of = digests(spots(text, known))
            prints = sorted(set(of.values()))
            if last is not None and last[0] == bucket:
                _, i, old, before, mine = last
                cut = len(old) // 3
                edited = old[:len(old) - cut] + text[:cut]
                changed = sorted(set(digests(spots(edited, known), before | of).values()))
                out.append((i, len(old), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), b"".join(mine).hex(), b"".join(changed).hex(),
                            pruned_jaccard(mine, changed), pruned_jaccard(mine, prints)))
            last = None if guest else (bucket, doc_id, text, of, prints)
        cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        yield pd.DataFrame(out, columns=cols).astype({"doc_id": "Int64"})


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                        anchors: list[str] | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: one row per input row.

    The edited text ends with the start of the next document (falling doc_id)
    in place of its last third. Null texts count as empty; an empty text has
    an empty fingerprint, which is like (1.0) an empty one only. Very long
    texts are read whole. Rows that repeat an id follow each other by the hash
    of their texts; rows without id come last. A single row is its own next
    one. Columns other than id, text and language are not read, a missing
    language column counts as null, and an empty table gives no rows.
    """
    C.prepare(docs.sparkSession)
    if anchors is None:
        lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
        anchors = anchor_words(docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text")))
    known = frozenset(w.encode() for w in anchors)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_next(docs, id_col, text_col).mapInPandas(lambda batches: _edits(batches, known), schema)
