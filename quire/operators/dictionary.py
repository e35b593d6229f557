"""Dictionary of typed items and the link graph between them.

Both stores are keyed on ``(item_type, item_id)``. The dictionary keeps the
latest item per key; the links of a key are replaced wholesale by those of
its latest item (an item whose ``links`` is null just deletes them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["item_type", "item_id"]
ITEM_COLUMNS = ["item_type", "item_id", "name", "description", "meta"]
EDGE_COLUMNS = ["link_type", "src_item_type", "src_item_id", "dst_item_type", "dst_item_id"]


def latest_per_key(items: DataFrame, key=KEY, order: str = "seq") -> DataFrame:
    """Last item per key by ``order`` (a ``max_by`` aggregate: partial
    aggregation runs map-side, so a hot key is combined before the shuffle)."""
    others = [c for c in items.columns if c not in key]
    return (items.groupBy(*key)
            .agg(F.max_by(F.struct(*others), F.col(order)).alias("_last"))
            .select(*key, "_last.*"))


# Keys of one batch broadcast against the stored tables; larger batches shuffle.
MAX_BROADCAST_BATCH_KEYS = 1_000_000


def upsert(existing: DataFrame | None, items: DataFrame) -> DataFrame:
    """Insert or replace name, description and meta on key conflict.

    ``items`` carries ``seq``; ``meta`` may be a struct (stored as JSON).
    The batch always wins over the store, so stored rows are only filtered
    (anti join on the batch's keys, broadcast when small), never regrouped.
    """
    from quire.session import keyed_filter

    new = items.select(*KEY, "name", "description",
                       (F.to_json("meta") if dict(items.dtypes).get("meta", "").startswith("struct")
                        else F.col("meta")).alias("meta"), "seq")
    latest = latest_per_key(new).select(*ITEM_COLUMNS)
    if existing is None:
        return latest
    kept = keyed_filter(existing.select(*ITEM_COLUMNS), latest.select(*KEY), KEY, "left_anti",
                        MAX_BROADCAST_BATCH_KEYS)
    return kept.unionByName(latest)


def explode_links(items: DataFrame, keep_seq: bool = False) -> DataFrame:
    """One edge row per link of each item (null links give no rows)."""
    extra = ["seq"] if keep_seq else []
    return (items.select(F.col("item_type").alias("src_item_type"),
                         F.col("item_id").alias("src_item_id"), *extra,
                         F.explode("links").alias("l"))
            .select(F.col("l.link_type").alias("link_type"), "src_item_type", "src_item_id",
                    F.col("l.item_type").alias("dst_item_type"),
                    F.col("l.item_id").alias("dst_item_id"), *extra))


def replace_edges(existing: DataFrame | None, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    """U3 in row form: every edge of a touched source key is dropped, the
    fresh edges are added. ``touched`` has ``src_item_type, src_item_id``
    (keys whose latest item was processed, with or without links)."""
    from quire.session import keyed_filter

    fresh = fresh.select(*EDGE_COLUMNS)
    if existing is None:
        return fresh
    keys = touched.select("src_item_type", "src_item_id").distinct()
    kept = keyed_filter(existing, keys, ["src_item_type", "src_item_id"], "left_anti", MAX_BROADCAST_BATCH_KEYS)
    return kept.select(*EDGE_COLUMNS).unionByName(fresh)


def latest_edges(edges: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of the latest item per key when one batch touches a key twice.

    ``items(src_item_type, src_item_id, seq)`` lists every processed item
    (links or not); ``edges`` carry the ``seq`` of their item. The latest
    seq per key is a ``max`` aggregate; edges are kept by a semi join -
    no key's edges are ever gathered into one array, and the keys, which grow
    with the batch, are never broadcast.
    """
    last = items.groupBy("src_item_type", "src_item_id").agg(F.max("seq").alias("seq"))
    return last, edges.join(last.hint("merge"), ["src_item_type", "src_item_id", "seq"], "left_semi")


def replace_links(existing: DataFrame | None, items: DataFrame) -> DataFrame:
    """Drop every edge of a touched source key, insert the edges of its
    latest item. Edges of untouched keys stay as they are."""
    keyed = items.select(F.col("item_type").alias("src_item_type"),
                         F.col("item_id").alias("src_item_id"), "seq", "links")
    edges = explode_links(items.select(*KEY, "links", "seq"), keep_seq=True)
    touched, fresh = latest_edges(edges, keyed.select("src_item_type", "src_item_id", "seq"))
    return replace_edges(existing, touched, fresh)


def links_with_source(links: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Edges whose source item exists (ON DELETE CASCADE semantics)."""
    keys = dictionary.select(F.col("item_type").alias("src_item_type"),
                             F.col("item_id").alias("src_item_id"))
    return links.join(keys, ["src_item_type", "src_item_id"], "left_semi")


def resolve_links(links: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Edges with their destination's name; unresolved edges are kept
    (legal) with ``resolved = false``."""
    dst = dictionary.select(F.col("item_type").alias("dst_item_type"),
                            F.col("item_id").alias("dst_item_id"),
                            F.col("name").alias("dst_name"),
                            F.lit(True).alias("resolved"))
    return (links.join(dst, ["dst_item_type", "dst_item_id"], "left")
            .withColumn("resolved", F.coalesce("resolved", F.lit(False))))


def dangling_links(links: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Edges whose destination does not exist."""
    keys = dictionary.select(F.col("item_type").alias("dst_item_type"),
                             F.col("item_id").alias("dst_item_id"))
    return links.join(keys, ["dst_item_type", "dst_item_id"], "left_anti")


def distinct_links(links_col) -> "F.Column":
    """A5: distinct links in first-seen order, keyed on the whole struct."""
    return F.array_distinct(links_col)
