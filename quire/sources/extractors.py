"""Source extractors (X1) and the source jobs built from them.

A source is a function from stored pages/responses (DataFrames) to items in
the feed form of :mod:`quire.schemas` (``source_id`` always set). The
registry maps a source id to its extractor, so adding a source is adding a
function - no crawler process, no spider discovery.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators import frontier as fr
from quire.operators import ingest as ing
from quire.operators import ledger as led
from quire.operators import links as lk
from quire.operators.ids import sequential_ids
from quire.operators.ordering import ordered_release
from quire.session import bounded_broadcast, cut_lineage
from quire.sources import dictionary_pages as dp
from quire.sources import html_pages as hp
from quire.sources import jsonpages as jp


@dataclass
class SourceRun:
    """What a source gives, whatever its kind: items in feed form, rejects,
    requests to be fetched next, and responses that still wait."""
    items: DataFrame | None
    rejects: DataFrame | None
    requests: DataFrame | None = None
    edges: DataFrame | None = None
    pending: DataFrame | None = None


EXTRACTORS: dict[str, Callable[..., SourceRun]] = {}

# Page layouts of the news source.
NEWS_POST_REGION = ("div", "post")   # listing: links are taken inside these blocks
NEWS_OLDER_CLASS = "older-posts"     # listing: link to the next (older) listing page
NEWS_TEXT_BLOCK = ("div", "text")    # article: the block that is the document
# Requests broadcast to their responses; more of them are joined by shuffle.
MAX_BROADCAST_REQUESTS = 100_000


def extractor(source_id: str):
    """Register ``fn(**stored inputs) -> SourceRun`` under ``source_id``."""
    def deco(fn):
        EXTRACTORS[source_id] = fn
        return fn
    return deco


def run_sources(inputs: dict[str, dict], routes: DataFrame, ledger: DataFrame | None = None, **options) -> tuple[ing.IngestResult, DataFrame]:
    """Every source named in ``inputs`` by its registered extractor, all
    their items through one ingest job. Returns the result of the job and the
    rejects of extraction and ingest."""
    feed, rejects = None, None
    for source_id, stored in inputs.items():
        run = EXTRACTORS[source_id](**stored)
        if run.items is not None:
            items = ing.with_seq(ing.conform(run.items))
            feed = items if feed is None else feed.unionByName(items, allowMissingColumns=True)
        if run.rejects is not None:
            rejects = run.rejects if rejects is None else rejects.unionByName(run.rejects)
    if feed is None:
        raise ValueError("no source gives items")
    res = ing.ingest(feed, ledger, routes, **options)
    return res, res.rejects if rejects is None else rejects.unionByName(res.rejects)


def seeds(spark, start_urls: dict[str, list[str]]) -> DataFrame:
    """The start requests of each source as a frame ``(source_id, url)``."""
    rows = [(s, u) for s, urls in start_urls.items() for u in urls]
    return spark.createDataFrame(rows, "source_id string, url string")


def read_html_files(spark, path: str) -> DataFrame:
    """Stored HTML files as ``(url, html)`` - one row per file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")))


def project_documents(spark, path: str, project_id: int) -> DataFrame:
    """The documents of one project (partition pruning on project_id)."""
    return spark.read.parquet(path).where(F.col("project_id") == project_id)


def carry_request_fields(responses: DataFrame, requests: DataFrame, fields: list[str]) -> DataFrame:
    """Responses get the fields of the request that fetched them. Responses
    hold whole pages, which Spark takes for a few bytes where an expression makes
    them; they are never broadcast. Requests are where they are measured to be small."""
    small, broadcast = bounded_broadcast(requests.select("url", *fields), MAX_BROADCAST_REQUESTS)
    return responses.join(small if broadcast else small.hint("merge"), "url", "left")


def assign_seq(items: DataFrame, order: list[str]) -> DataFrame:
    """O1: explicit arrival order ``seq`` from sort columns (e.g. oldest
    change first: ``["modified_at", "source_url"]``), without a global window."""
    return sequential_ids(items, order, start=0, id_col="seq")


# --- page structure ----------------------------------------------------------------

def css(pages: DataFrame, key: str, html: str, *, links_in: tuple[str, str | None] | None = None,
        first: tuple[str, str | None] | None = None, next_link_class: str | None = None) -> DataFrame:
    """(key, hrefs, first_html, next_href): links inside the balanced blocks
    ``links_in`` (restrict_css), markup of the first block ``first`` and the
    next-page link of every page, as native expressions."""
    h, none = F.col(html), F.lit(None).cast("string")
    hrefs = F.filter(lk.anchors(lk.region(h, *links_in)), lambda x: x != "") if links_in else F.array().cast("array<string>")
    return pages.select(
        F.col(key).cast("string").alias("key"), hrefs.alias("hrefs"),
        (F.try_element_at(lk.regions(h, *first), F.lit(1))["outer"] if first else none).alias("first_html"),
        (lk.link_with_class(h, next_link_class) if next_link_class else none).alias("next_href"))


# --- C3: the conditions source (index JSON + article JSON) -------------------------

@dataclass
class Release:
    items: DataFrame      # html items in feed form (+ page_no, position)
    rejects: DataFrame    # (source_id, url, stage, reason)
    pending: DataFrame    # responses still waiting, in the input shape
    released: DataFrame   # (page_no, released_upto): last slot released per page


def conditions_release(articles: DataFrame, source_id: str = "conditions") -> Release:
    """Article responses ``(url, status, body, page_no, position, arrival)``
    -> html items released in list order (W2/T4) with ``seq``.

    Every response fills its slot. Non-200 responses and articles without
    text give no item (P6, P7); an article without ``dateModified`` is
    rejected alone; a slot filled twice rejects the later arrival (W3), a
    response without page or position is rejected. Items behind an empty slot
    stay pending.
    """
    cols = articles.columns
    a = (jp.parse_article(articles).withColumnRenamed("status", "http_status")
         .withColumn("has_date", (F.col("http_status") != 200) |
                     F.get_json_object("body", "$.dateModified").isNotNull()))
    r = ordered_release(a, page="page_no", position="position", arrival="arrival")
    no_slot = F.col("page_no").isNull() | F.coalesce(F.col("position") < 0, F.lit(True))
    reason = (F.when(no_slot, F.lit("no slot")).when(F.col("status") == "rejected", F.lit("slot already filled"))
              .when(F.col("http_status") != 200, F.concat(F.lit("status "), F.col("http_status").cast("string")))
              .when(~F.col("has_date"), F.lit("no dateModified"))
              .when(F.coalesce(F.col("html"), F.lit("")) == "", F.lit("no text")))
    r = cut_lineage(r.withColumn("reason", F.when(F.col("status") != "pending", reason)))
    rejects = r.where(F.col("reason").isNotNull()).select(
        F.lit(source_id).alias("source_id"), "url", F.lit("extract").alias("stage"), "reason")
    ok = r.where((F.col("status") == "released") & F.col("reason").isNull())
    items = assign_seq(ok.select("page_no", "position", "url", "html", "modified_at"), ["page_no", "position"])
    items = items.select("seq", F.lit("html").alias("kind"), F.lit(source_id).alias("source_id"),
                         F.col("url").alias("source_url"), "html", "modified_at", "page_no", "position")
    pending = (r.where(F.col("status") == "pending").drop("status")
               .withColumnRenamed("http_status", "status").select(*cols))
    released = (r.where(F.col("status") == "released").groupBy("page_no")
                .agg(F.max("position").alias("released_upto")))
    return Release(items, rejects, pending, released)


def conditions_items(articles: DataFrame, source_id: str = "conditions"):
    """C3 as ``(items, rejects, pending)`` - see :func:`conditions_release`."""
    rel = conditions_release(articles, source_id)
    return rel.items.drop("page_no", "position"), rel.rejects, rel.pending


@extractor("conditions")
def run_conditions(articles: DataFrame, index_pages: DataFrame | None = None) -> SourceRun:
    """C3 by its inputs: stored article responses, and index pages if there are any."""
    items, rejects, pending = conditions_items(articles)
    return SourceRun(items, rejects, conditions_requests(index_pages) if index_pages is not None else None, pending=pending)


def conditions_requests(index_pages: DataFrame) -> DataFrame:
    """C3 index side: result links become forced fetches with list position
    and priority; a page without results requests its next page."""
    req = jp.parse_index(index_pages, keys=["page_no"])
    return req.withColumn("force_refresh", F.col("kind") == "item")


# --- C4: news listings, news articles, review pages -----------------------------------

def news_requests(listings: DataFrame, ledger: DataFrame | None, allow: str, *,
                  region=NEWS_POST_REGION, older_class: str = NEWS_OLDER_CLASS) -> tuple[DataFrame, DataFrame]:
    """C4 listing side: links inside the post blocks matching ``allow``
    (P11), one request per URL (U8), URLs already held with a time skipped
    (J2). Returns ``(requests, listing_edges)`` - the edges ``(src, dst)``
    to the older-posts page drive :func:`quire.operators.frontier.walk` (N4)."""
    found = css(listings, "url", "html", links_in=region, next_link_class=older_class)
    links = (found.select(F.col("key").alias("page"), F.posexplode("hrefs").alias("pos", "href"))
             .withColumn("abs_url", lk.resolve_url("page", "href")))
    reqs = lk.first_seen(lk.allowed(links, allow), order=("page", "pos"))
    reqs = reqs.withColumn("dont_refresh", F.lit(True))
    if ledger is not None:
        reqs = led.skip_known(reqs, ledger)
    edges = (found.where(F.col("next_href").isNotNull())
             .select(F.col("key").alias("src"), lk.resolve_url("key", "next_href").alias("dst")))
    return reqs, edges


def news_items(articles: DataFrame, run_ts: Column, source_id: str = "news",
               block=NEWS_TEXT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """C4 article side: the first text block's markup is the item (P8: no
    block -> reject); the fetch time is the item's time."""
    found = cut_lineage(css(articles, "url", "html", first=block))     # read once for items, their numbering and rejects
    items = found.where(F.col("first_html").isNotNull()).select(
        F.lit("html").alias("kind"), F.lit(source_id).alias("source_id"),
        F.col("key").alias("source_url"), F.col("first_html").alias("html"), run_ts.alias("modified_at"))
    rejects = found.where(F.col("first_html").isNull()).select(
        F.lit(source_id).alias("source_id"), F.col("key").alias("url"),
        F.lit("extract").alias("stage"), F.lit("no text block").alias("reason"))
    return items, rejects


def review_items(pages: DataFrame, source_id: str = "reviews") -> tuple[DataFrame, DataFrame]:
    """C4 reviews: several documents per page (N6), no time; blocks without
    headline, text or comment id are rejected (P14)."""
    b = cut_lineage(hp.review_blocks(pages))       # parsed once for items, their numbering and rejects
    items = b.where(F.col("status") == "ok").select(
        F.lit("html").alias("kind"), F.lit(source_id).alias("source_id"), "source_url", "html",
        F.lit(None).cast("timestamp").alias("modified_at"))
    rejects = b.where(F.col("status") != "ok").select(
        F.lit(source_id).alias("source_id"), "url", F.lit("extract").alias("stage"), F.col("status").alias("reason"))
    return items, rejects


@extractor("news")
def run_news(articles: DataFrame, run_ts: Column, listings: DataFrame | None = None, ledger: DataFrame | None = None,
             allow: str = "") -> SourceRun:
    """C4 news by its inputs: fetched articles, and listing pages if there are any."""
    items, rejects = news_items(articles, run_ts)
    requests, edges = news_requests(listings, ledger, allow) if listings is not None else (None, None)
    return SourceRun(items, rejects, requests, edges)


@extractor("reviews")
def run_reviews(pages: DataFrame) -> SourceRun:
    """C4 reviews by their pages."""
    return SourceRun(*review_items(pages))


# --- C5: the dictionary source -----------------------------------------------------

def dictionary_items(index_pages: DataFrame, item_pages: DataFrame, seeds_df: DataFrame,
                     source_id: str = "dictionary") -> tuple[DataFrame, DataFrame]:
    """Index pages (five item types, the data-set tree expanded from the
    seeds, N5) give ``(item_type, item_id, url)``; the stored item pages are
    joined on URL (J8 carries the id) and extracted (X4). Returns
    ``(items, rejects)`` in feed form for :func:`quire.operators.ingest.ingest`."""
    flat = dp.parse_index_pages(index_pages.where(F.col("item_type") != "dataSet"))
    tree = dp.expand_index(index_pages.where(F.col("item_type") == "dataSet"),
                           seeds_df.where(F.col("item_type") == "dataSet"))
    entries = cut_lineage(flat.unionByName(tree))      # pages are parsed once for all that follows
    bad = entries.where(F.col("status") != "ok").select(
        F.lit(source_id).alias("source_id"), F.col("href").alias("url"),
        F.lit("index").alias("stage"), F.lit("no id in href").alias("reason"))
    # the fetched page is the URL without its fragment
    want = fr.dedup_requests(entries.where(F.col("status") == "ok")
                             .select(F.regexp_replace("url", "#.*$", "").alias("url"), "item_type", "item_id",
                                     F.lit(0).cast("long").alias("seq")))
    pages = carry_request_fields(item_pages.select(F.col("url"), "html", "last_modified"),
                                 want, ["item_type", "item_id"]).where(F.col("item_id").isNotNull())
    out = dp.extract_items(pages.withColumnRenamed("url", "source_url"))
    items = out.where(F.col("status") == "ok").drop("status", "bad_rows").withColumn("source_id", F.lit(source_id))
    # a page without an item is one reject, an attribute row without a link another
    reasons = F.when(F.col("status") != "ok", F.array("status")).otherwise(
        F.array_repeat(F.lit("attribute row without link"), F.col("bad_rows")))
    rejects = bad.unionByName(out.select(F.lit(source_id).alias("source_id"), F.col("source_url").alias("url"),
                                         F.lit("extract").alias("stage"), F.explode(reasons).alias("reason")))
    return items, rejects


@extractor("dictionary")
def run_dictionary(index_pages: DataFrame, item_pages: DataFrame, seeds_df: DataFrame) -> SourceRun:
    """C5 by its inputs: index pages, item pages and the tree's seeds."""
    return SourceRun(*dictionary_items(index_pages, item_pages, seeds_df))
