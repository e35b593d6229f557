"""MinHash near-duplicates with b-bit signatures.

Every distinct shingle set is hashed once: minima under ``PERMS``
permutations give band keys (candidates), and their low ``BITS`` bits are
packed into longs. A candidate pair is kept while the similarity estimated
from equal lanes, corrected for chance collisions, is not clearly below the
threshold, and is then confirmed on the two full sets.

No group is ever expanded into all its pairs. Equal sets fall into one class
first. Members of a band bucket are compared with one pivot, components are
formed, and only buckets that still hold several components go on, without
the settled pivot. Large open buckets take a second pivot; what is left is
compared in blocks of ``BLOCK`` members (and ``BLOCK_BYTES`` of sets) inside
tasks, which send out only confirmed links. Every candidate pair is thus
either compared or already in one component.

Nodes are numbers: ids as they are, and for string keys the place of a class
among all classes, in key order. The sets of all nodes that share a bucket are
made in one pass over the texts.

With 32 bands of 4 rows a pair of similarity 0.8 shares no band with
probability 5e-8; the estimate's margin is over four standard deviations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C
from quire.llm.components import connected_components
from quire.operators.ids import sequential_ids
from quire.session import bounded_broadcast

PERMS, ROWS, BITS = 128, 4, 4
SEED = 20240613
MARGIN = 0.16
BLOCK, BLOCK_BYTES = 256, 8 << 20
MAX_BROADCAST_NODES = 2_000_000
PIVOT_ROUNDS = 2
_SIG = "doc_id long, n_shingles long, set_key string, bands array<long>, packed array<long>"


def pack(low: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of the minima, ``64 / BITS`` lanes to a long."""
    lanes = 64 // BITS
    low = low.astype(np.uint64) & np.uint64((1 << BITS) - 1)
    return np.bitwise_or.reduce(low.reshape(-1, lanes) << (np.arange(lanes, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def equal_lanes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lanes that agree, for arrays of packed signatures (last axis: longs)."""
    d = x ^ y
    for s in (1, 2):
        d = d | (d >> np.uint64(s))
    return PERMS - np.bitwise_count(d & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)


def corrected(equal):
    """Similarity estimated from the share of equal lanes, of which 2^-BITS agree by chance."""
    chance = 2.0 ** -BITS
    return (equal / PERMS - chance) / (1 - chance)


def _estimate(x: str, y: str):
    """The same estimate as a column, for two array<long> columns."""
    diff = F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))
    one = F.lit(0x1111111111111111)

    def lanes(d):
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(one))

    unequal = F.aggregate(F.transform(diff, lanes), F.lit(0), lambda a, v: a + v)
    return corrected(F.lit(PERMS) - unequal)


def shingle_set(text, width: int) -> np.ndarray:
    return np.unique(C.shingle_hashes(C.word_hashes(C.words_of(text)), width))


def _kind(docs: DataFrame) -> str:
    """Type of the ids: bigint, or string for row keys."""
    return dict(docs.dtypes)["doc_id"]


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: set size, key of the set, band keys, packed low bits."""
    perms = C.permutations(PERMS, SEED)
    salt = C.mix64(np.arange(1, PERMS // ROWS + 1, dtype=np.uint64))
    kind = _kind(docs)

    def run(batches):
        C.free_model()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                s = shingle_set(text, width)
                if not len(s):
                    rows.append((doc_id, 0, None, None, None))
                    continue
                m = C.minima((s >> np.uint64(32)).astype(np.uint32), perms)
                rest = m.reshape(-1, ROWS).astype(np.uint64)
                keys = salt.copy()
                for k in range(ROWS):
                    keys = C.mix64(keys ^ rest[:, k])
                rows.append((doc_id, len(s), xxhash.xxh3_128_hexdigest(s.tobytes()), keys.view(np.int64), pack(m).view(np.int64)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "bands", "packed"])
            yield out.astype({"doc_id": "Int64"}) if kind == "bigint" else out

    return docs.mapInPandas(run, _SIG.replace("doc_id long", f"doc_id {kind}"))


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, members) of ``docs`` (node, text): the sorted set as little-endian 64-bit values."""
    def run(batches):
        C.free_model()
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "members": [shingle_set(t, width).tobytes() for t in pdf["text"]]})

    return docs.mapInPandas(run, "node long, members binary")


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    n = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * n >= percent * (len(x) + len(y) - n)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    def run(batches):
        for pdf in batches:
            keep = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(pdf["x"], pdf["y"], strict=True)]
            yield pdf.loc[keep, ["a", "b"]]

    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b"))
    return full.mapInPandas(run, "a long, b long")


def _estimated(pairs: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    p = (pairs.join(packed.select(F.col("node").alias("a"), F.col("packed").alias("pa")), "a")
         .join(packed.select(F.col("node").alias("b"), F.col("packed").alias("pb")), "b"))
    return p.where(_estimate("pa", "pb") >= least).select("a", "b").distinct()


def _block_links(opened: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between different components of open buckets.

    A bucket is dealt into blocks of about BLOCK members, fewer where their
    sets are long; each pair of blocks is one bounded group, which gets its
    members' signatures and sets. Inside,
    a pair that shares several buckets is looked at in its first one, pairs
    are taken by falling estimate, and a confirmed link joins the two
    components there and then, so that what it settles is not compared again.
    """
    least = percent / 100 - MARGIN
    about = classes.select("node", "bands", "packed").join(sets, "node")
    m = dealt(opened).join(about, "node")

    def run(pdf):
        key, i, j = pdf["key"].iat[0], pdf["i"].iat[0], pdf["j"].iat[0]
        left, right = pdf[pdf["blk"] == i], pdf[pdf["blk"] == j]
        out = []
        if len(left) and len(right):
            names = {c: k for k, c in enumerate(pdf["comp"].unique())}
            lc, rc = (np.array([names[c] for c in x["comp"]]) for x in (left, right))
            bands = np.array(right["bands"].tolist(), np.int64)
            packed = np.array(right["packed"].tolist(), np.int64).view(np.uint64)
            nodes_, sets_ = right["node"].to_numpy(), right["members"].tolist()
            for k, (node, own, sig, text) in enumerate(zip(left["node"], left["bands"], left["packed"], left["members"], strict=True)):
                near = np.flatnonzero((rc != lc[k]) & ((nodes_ > node) if i == j else True))
                if not len(near):
                    continue
                est = corrected(equal_lanes(np.asarray(sig, np.int64).view(np.uint64), packed[near]))
                own = np.asarray(own, np.int64)
                hit = (est >= least) & (own[(bands[near] == own).argmax(axis=1)] == key)
                near, est = near[hit], est[hit]
                mine = np.frombuffer(text, np.uint64)
                for y in near[np.argsort(-est, kind="stable")].tolist():
                    if rc[y] != lc[k] and alike(mine, np.frombuffer(sets_[y], np.uint64), percent):
                        out.append((node, nodes_[y]))
                        old = rc[y]
                        rc[rc == old] = lc[k]
                        lc[lc == old] = lc[k]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return m.groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()


def links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(node, component) over the classes' nodes; None when nothing is linked.
    ``classes``: rep (id or key), node, n_shingles, bands, packed."""
    least = percent / 100 - MARGIN
    packed = classes.select("node", "packed")
    rows = classes.select("node", (F.col("n_shingles") * 8).alias("bytes"), F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = C.stored(rows.join(shared, "key").withColumn("pri", F.xxhash64("node")), "dedup-members")
    nodes, _ = bounded_broadcast(classes.select("node", "rep").distinct().join(members.select("node"), "node", "left_semi"), MAX_BROADCAST_NODES)
    # an id that stands for several texts has several sets
    sets = C.stored(shingle_sets(docs.join(nodes, docs["doc_id"] == nodes["rep"]).select("node", "text"), width).distinct(), "dedup-sets")
    return linked(members, lambda pairs: confirmed(_estimated(pairs, packed, least), sets, percent),
                  lambda opened: _block_links(opened, classes, sets, percent))


def linked(members: DataFrame, verify, in_blocks) -> DataFrame | None:
    """(node, component) from bucket ``members`` (node, bytes, key, pri); None
    when nothing is linked. ``verify`` keeps the true ones of pairs (a, b),
    ``in_blocks`` gives the true links inside buckets that stay open."""
    edges: DataFrame | None = None
    comps: DataFrame | None = None
    for step in range(PIVOT_ROUNDS + 1):
        m = members.withColumn("comp", F.col("node")) if comps is None else (
            members.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component"))
        heads = m.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                     F.min_by(F.struct("node", "comp"), "pri").alias("head")).where("lo < hi")
        opened = C.stored(m.join(heads.select("key", "n", "size", "head"), "key"), "dedup-open")
        most = opened.agg(F.max("n")).head()[0]
        if most is None:
            break
        last = step == PIVOT_ROUNDS or (step and most <= BLOCK)
        good = in_blocks(opened) if last else verify(
            opened.where("comp <> head.comp").select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct())
        good = C.stored(good, "dedup-links")
        if good.head() is not None:
            edges = good if edges is None else edges.union(good)
            comps = C.stored(connected_components(edges), "dedup-components")
        if last:
            break
        members = opened.where("node <> head.node").select("node", "bytes", "key", "pri")
    return comps


def dealt(opened: DataFrame) -> DataFrame:
    """Members of open buckets, dealt into bounded groups (key, i, j), one per
    pair of blocks; ``blk`` tells a member's block. Members of a bucket's
    largest component (blocks -1, -2, ..) meet the other components' members
    only, not each other, so a bucket that is nearly settled costs about a row
    a member."""
    per = opened.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    big = per.groupBy("key").agg(F.max(F.struct("c", F.col("comp").alias("big"))).alias("b")).select("key", "b.c", "b.big")
    m = opened.join(big, "key").withColumn("rest", F.col("n") - F.col("c"))
    share = F.greatest(F.lit(1.0), F.col("size") / F.col("n") * BLOCK / BLOCK_BYTES)      # long sets make smaller blocks
    m = m.withColumn("few", F.ceil(F.col("rest") / BLOCK * share).cast("int")).withColumn("many", F.ceil(F.col("c") / BLOCK * share).cast("int"))
    few, many = F.sequence(F.lit(0), F.col("few") - 1), F.sequence(F.lit(0), F.col("many") - 1)
    own = F.when(F.col("comp") == F.col("big"), -1 - F.pmod(F.xxhash64("node"), F.col("many"))).otherwise(F.pmod(F.xxhash64("node"), F.col("few"))).cast("int")
    m = m.withColumn("blk", own)
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    groups = F.when(F.col("blk") < 0, F.transform(few, lambda o: pair(o, F.col("blk")))).otherwise(F.concat(
        F.transform(few, lambda o: pair(F.least(o, F.col("blk")), F.greatest(o, F.col("blk")))), F.transform(many, lambda o: pair(F.col("blk"), -1 - o))))
    return m.withColumn("g", F.explode(groups)).select("key", "g.i", "g.j", "blk", "node", "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    component_id is the smallest doc_id reachable over links of similarity
    >= percent / 100; kept marks that document. Null, empty and blank texts
    have an empty set, are linked with nothing and stay. Texts of fewer than
    ``width`` words are one shingle. Rows that repeat a doc_id count as one
    document with several texts. A row with a null doc_id takes its class's
    component and is kept only if no row with an id has the same set. Columns
    other than id and text are not read. An empty table gives no rows.
    """
    C.prepare(docs.sparkSession)
    own = C.ids_only(docs, id_col, text_col)
    sig = C.stored(signatures(own, width), "dedup-signatures")
    classes = (sig.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
               .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("packed").alias("packed")))
    if _kind(own) == "string":
        classes = C.stored(classes, "dedup-sets-classes")
        classes = classes.join(sequential_ids(classes.select("rep"), ["rep"], id_col="node"), "rep")
    else:
        classes = classes.withColumn("node", F.col("rep"))
    classes = C.stored(classes, "dedup-classes")
    comps = links(own.where("doc_id IS NOT NULL"), classes, width, percent)
    if comps is None:
        of_class = classes.select("set_key", F.col("rep").alias("component_id"))
    elif _kind(own) == "bigint":
        of_class = classes.join(comps, "node", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    else:
        linked = classes.select("set_key", "rep", "node").join(comps, "node", "left")
        heads = classes.select(F.col("node").alias("component"), F.col("rep").alias("head"))
        of_class = linked.join(heads, "component", "left").select("set_key", F.coalesce("head", "rep").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                         percent: int = 80, by_row: bool = False) -> DataFrame:
    """``docs`` without the documents that are not the kept one of their
    group; all columns as they were. A doc_id goes with all its rows, rows
    without id stay. With ``by_row`` the nodes are rows (id and text): rows
    without id are compared and dropped like all others, behind those with an
    id, and of their exact copies with words one stays; rows that repeat an id
    and its text are one document still."""
    if by_row:
        out = C.by_row(docs, id_col, text_col, lambda d, key: drop_near_duplicates(d, key, text_col, width, percent))
        bare = F.col(f"`{id_col}`").isNull() & F.coalesce(F.regexp_like(f"`{text_col}`", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
        if docs.where(F.col(f"`{id_col}`").isNull()).head() is None:
            return out
        return out.where(~bare).unionByName(out.where(bare).dropDuplicates([text_col]))
    found = C.stored(near_duplicates(docs, id_col, text_col, width, percent), "dedup-result")
    return C.without_ids(docs, id_col, found.where(~F.col("kept")).select("doc_id").where("doc_id IS NOT NULL").distinct())
