"""The ingest job (C1): item feed -> rejects -> ledger -> text -> stores.

One call turns a batch of items and the current stores into the next
stores. Everything is a DataFrame; nothing is collected. Writing the
results (targets first, ledger last) is the caller's job - see
:mod:`quire.sinks.tables` and :mod:`quire.streaming.ingest`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.markup import strip_tags, strip_tags_exact
from quire.functions.text import doc_meta_json, doc_name
from quire.operators import dictionary as dct
from quire.operators import ledger as led
from quire.operators.ids import sequential_ids
from quire.session import bounded_broadcast

# Routes are one row per configured source; above this they are joined by shuffle.
MAX_BROADCAST_ROUTES = 100_000
# Arrival numbers given to items that come without one start here.
UNNUMBERED = 1 << 62


@dataclass
class IngestResult:
    documents: DataFrame        # K2 rows (+ source_url, source_id for lineage)
    dictionary: DataFrame | None
    links: DataFrame | None
    ledger: DataFrame           # K1 new ledger state (whole)
    ledger_delta: DataFrame     # K1 new state of the touched URLs only (ledger log layout)
    rejects: DataFrame          # K13
    passthrough: DataFrame      # P1 unknown kinds, untouched
    trainer: DataFrame | None   # K5 concept-trainer rows, if enabled
    decided: DataFrame          # the items with their decision; every output above derives from it


def conform(items: DataFrame) -> DataFrame:
    """Add the item-feed columns a source does not produce, as typed nulls."""
    have = set(items.columns)
    for f in schemas.ITEMS.fields:
        if f.name not in have:
            items = items.withColumn(f.name, F.lit(None).cast(f.dataType))
    return items


def _numbered(items: DataFrame) -> DataFrame:
    """Arrival numbers from the data: by time (none first), URL and content.
    They are stored with the rows, so everything that derives from the items
    sees the same numbers, however its shuffles are planned."""
    plain = [c for c, t in items.dtypes if "map<" not in t and "variant" not in t]
    order = [c for c in ("modified_at", "source_url") if c in items.columns]
    rows = items.withColumn("_content", F.xxhash64(*plain) if plain else F.lit(0))
    return sequential_ids(rows, [*order, "_content"], start=UNNUMBERED, id_col="seq").drop("_content")


def with_seq(items: DataFrame) -> DataFrame:
    """O1: every item an arrival number. Rows without one (or all rows, when
    the source produces none) are numbered behind the others."""
    if "seq" not in items.columns:
        return _numbered(items)
    bare = items.where(F.col("seq").isNull())
    if bare.isEmpty():
        return items
    return items.where(F.col("seq").isNotNull()).unionByName(_numbered(bare.drop("seq")))


def classify(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a feed into (candidates, rejects, passthrough)."""
    items = conform(items)
    known = F.col("kind").isin(schemas.KNOWN_KINDS)
    passthrough = items.where(~known | F.col("kind").isNull())
    cand = items.where(known)
    reason = (F.when(F.col("source_url").isNull(), F.lit("missing source_url"))
              .when(F.length("source_url") > schemas.MAX_URL, F.lit("source_url too long"))
              .when(F.length("source_id") > schemas.MAX_SOURCE_ID, F.lit("source_id too long"))
              .when((F.col("kind") == "dictionary") &
                    ((F.length("item_type") > schemas.MAX_ITEM_KEY) |
                     (F.length("item_id") > schemas.MAX_ITEM_KEY) |
                     (F.length("name") > schemas.MAX_ITEM_NAME)), F.lit("dictionary key too long")))
    tagged = cand.withColumn("_reason", reason)
    rejects = (tagged.where(F.col("_reason").isNotNull())
               .select("source_id", F.col("source_url").alias("url"),
                       F.lit("classify").alias("stage"), F.col("_reason").alias("reason")))
    return tagged.where(F.col("_reason").isNull()).drop("_reason"), rejects, passthrough


def to_text(items: DataFrame, exact: bool = False) -> DataFrame:
    """P5: html items become text items (``html`` replaced, all else kept)."""
    f = strip_tags_exact if exact else strip_tags
    return (items.withColumn("text", F.when(F.col("kind") == "html", f(F.col("html")))
                             .otherwise(F.col("text")))
            .withColumn("kind", F.when(F.col("kind") == "html", F.lit("text")).otherwise(F.col("kind")))
            .drop("html"))


def route(items: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach project and dataset ids by source (routes broadcast when small)."""
    r, _ = bounded_broadcast(routes.select("source_id", "project_id", "dataset_id"),
                             MAX_BROADCAST_ROUTES)
    return items.join(r, "source_id", "left")


def document_rows(corpus: DataFrame, run_ts: Column) -> DataFrame:
    """K2: stored document rows (filename 'spidered', created = updated = run time)."""
    return corpus.select(
        "text",
        doc_meta_json("source_id", "source_url").alias("meta"),
        run_ts.alias("created_at"), run_ts.alias("updated_at"),
        F.col("project_id").cast("long").alias("project_id"),
        F.lit("spidered").alias("filename"),
        "source_id", "source_url")


def ingest(items: DataFrame, ledger: DataFrame | None, routes: DataFrame, *,
           dictionary: DataFrame | None = None, links: DataFrame | None = None,
           run_ts: Column | None = None, exact_text: bool = False,
           policy: str = "different", chunk: int = led.DEFAULT_CHUNK, trainer: bool = True,
           persist: bool = False) -> IngestResult:
    """C1 for one batch. ``ledger`` is the stored ledger, or just its rows
    for the batch's URLs (``LedgerLog.rows_for``); write ``ledger_delta`` to
    the log, or ``ledger`` as a new version. Every output derives from one
    decision frame, kept with ``persist`` when several outputs are written
    (``decided.unpersist()`` afterwards).

    Nothing vanishes: accepted items, rejects and passthrough rows add up to
    the input. ``trainer=False`` leaves the concept-trainer rows out (K5)."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    cand, rejects, passthrough = classify(with_seq(items))
    decided = led.decide(cand, ledger, policy=policy, chunk=chunk)
    if persist:
        decided = decided.persist()
    new_ledger = led.apply(ledger, decided)
    dropped = (decided.where(~F.col("accepted"))
               .select("source_id", F.col("source_url").alias("url"),
                       F.lit("ledger").alias("stage"), F.lit("unchanged").alias("reason")))
    accepted = decided.where("accepted").drop("accepted")

    corpus = route(to_text(accepted.where(F.col("kind").isin(schemas.CORPUS_KINDS)), exact_text), routes)
    docs = document_rows(corpus, run_ts)
    train = corpus.select(doc_name("source_url").alias("name"), "text", "dataset_id") if trainer else None

    dict_items = accepted.where(F.col("kind") == "dictionary")
    new_dict = dct.upsert(dictionary, dict_items)
    new_links = dct.replace_links(links, dict_items)
    return IngestResult(docs, new_dict, new_links, new_ledger, led.apply(None, decided),
                        rejects.unionByName(dropped), passthrough, train, decided)
