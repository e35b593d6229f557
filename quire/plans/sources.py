"""Named queries: the source jobs C3 (conditions), C4 (news listings) and
C5 (dictionary) end to end over stand-in pages built from driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.text import LINK_CLASSES
from quire.operators import ingest as ing
from quire.operators import links as lk
from quire.plans import standins as S
from quire.plans.graph import ALLOW, INDEX_DIRS
from quire.plans.pages import REVIEW_STATUS_SQL, review_pages
from quire.plans.registry import query
from quire.plans.store import DICT_SITE, TYPES_SQL, _dictionary_pages
from quire.sources import dictionary_pages as dp
from quire.sources import extractors as ex

# --- C3: article responses from conversations -------------------------------------

CONDITIONS_SITE = "https://health.example.org/c/"


def _article_responses(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    day = F.lpad(((F.col("conv_id") % 28) + 1).cast("string"), 2, "0")
    date = F.when(F.col("turn") != 3, F.concat(F.lit("2024-02-"), day, F.lit("T08:00:00+00:00")))
    body = F.to_json(F.struct(date.alias("dateModified"), F.array(F.struct(
        F.lit("markdown").alias("name"), F.col("text").alias("text"))).alias("mainEntityOfPage")))
    arrival = F.conv(F.substring(F.md5(F.concat(F.col("conv_id").cast("string"), F.lit("/"),
                                                F.col("turn").cast("string"))), 1, 8), 16, 10).cast("long")
    return c.select(
        F.concat(F.lit(CONDITIONS_SITE), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("url"),
        F.when(F.col("role") == "system", 404).otherwise(200).alias("status"), body.alias("body"),
        F.col("conv_id").alias("page_no"), F.col("turn").alias("position"), arrival.alias("arrival"))


@query("conditions_source", sql=f"""
WITH r AS (SELECT conv_id, turn, text, '{CONDITIONS_SITE}' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url,
                  CASE WHEN role = 'system' THEN 404 ELSE 200 END AS status FROM conversations),
k AS (SELECT * FROM r WHERE status = 200 AND turn <> 3 AND text <> '')
SELECT 'item' AS kind, row_number() OVER (ORDER BY conv_id, turn) - 1 AS seq, url AS source_url, text AS html,
       CAST('2024-02-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || ' 08:00:00' AS TIMESTAMP) AS modified_at,
       CAST(NULL AS VARCHAR) AS reason
FROM k
UNION ALL
SELECT 'reject', CAST(NULL AS BIGINT), url, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP),
       CASE WHEN status <> 200 THEN 'status 404' WHEN turn = 3 THEN 'no dateModified' ELSE 'no text' END
FROM r WHERE NOT (status = 200 AND turn <> 3 AND text <> '')""")
def conditions_source(spark, sf_dir):
    """C3 (S3, N1, P6, P7, W2, O1): article responses arriving shuffled are
    released in list order as html items with an arrival ``seq``; error
    responses, articles without a date and empty articles are rejected."""
    items, rejects, _ = ex.conditions_items(_article_responses(spark, sf_dir))
    it = items.select(F.lit("item").alias("kind"), "seq", "source_url", "html",
                      F.col("modified_at").cast("timestamp_ntz").alias("modified_at"),
                      F.lit(None).cast("string").alias("reason"))
    rj = rejects.select(F.lit("reject").alias("kind"), F.lit(None).cast("long").alias("seq"),
                        F.col("url").alias("source_url"), F.lit(None).cast("string").alias("html"),
                        F.lit(None).cast("timestamp_ntz").alias("modified_at"), "reason")
    return it.unionByName(rj)


# --- C4: listing pages --------------------------------------------------------------

NAV_REGION_SQL = "array_to_string(regexp_extract_all(html, '(?is)<nav(?:\\s[^>]*)?>(.*?)</nav\\s*>', 1), '')"
NAV_LINKS_SQL = f"""
SELECT url AS page, unnest(range(len(hs))) AS pos, unnest(hs) AS href
FROM (SELECT url, {lk.anchors_sql(NAV_REGION_SQL)} AS hs FROM pages)"""


@query("news_requests", sql=f"""
WITH l AS (SELECT page, pos, regexp_extract(page, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href AS url
           FROM ({NAV_LINKS_SQL})),
k AS (SELECT * FROM l WHERE regexp_matches(url, '{ALLOW}')),
f AS (SELECT url, page, pos, n_refs FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY page, pos) AS rk,
               count(*) OVER (PARTITION BY url) AS n_refs FROM k) WHERE rk = 1)
SELECT url, page, pos, n_refs, TRUE AS dont_refresh FROM f
WHERE NOT regexp_matches(url, '/[A-Z][a-z]*$')""")
def news_requests(spark, sf_dir):
    """C4 listing side (N8, P11, U8, J2): links inside the navigation block
    (a DOM selection) matching the allow pattern, one request per URL, URLs
    the ledger holds with a time skipped (here: capitalised paths)."""
    pages = S.table(spark, sf_dir, "pages")
    all_reqs, _ = ex.news_requests(pages, None, ALLOW, region=("nav", None))
    held = (all_reqs.where(F.col("url").rlike("/[A-Z][a-z]*$"))
            .select(F.lit("news").alias("source_id"), "url",
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modified_at")))
    reqs, _ = ex.news_requests(pages, held, ALLOW, region=("nav", None))
    return reqs.select("url", "page", F.col("pos").cast("long").alias("pos"), "n_refs", "dont_refresh")


# --- C4: news articles and reviews into the corpus -------------------------------------

NEWS_TIME = "2024-03-01 06:00:00"


def _news_pages(spark, sf_dir):
    """One fetched article per document; every document over 3,000
    characters lies on a page without a text block."""
    d = S.table(spark, sf_dir, "documents")
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    block = F.when(F.col("n_chars") > 3000, F.concat(F.lit('<div class="wide">'), esc, F.lit("</div>"))).otherwise(
        F.concat(F.lit('<div class="text main"><p>'), esc, F.lit('</p></div><div class="text">second</div>')))
    return d.select(F.concat(F.lit("https://news.example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
                    F.concat(F.lit("<html><body><div>menu</div>"), block, F.lit("</body></html>")).alias("html"))


def _outcome(res: ing.IngestResult, rejects):
    """Stored documents and rejects of a source run as one frame."""
    return (res.documents.select(F.lit("document").alias("outcome"), "source_url", "project_id", "text",
                                 F.lit(None).cast("string").alias("reason"))
            .unionByName(rejects.unionByName(res.rejects).select(
                F.lit("reject").alias("outcome"), F.col("url").alias("source_url"), F.lit(None).cast("long").alias("project_id"),
                F.lit(None).cast("string").alias("text"), "reason")))


@query("news_ingest", sql=f"""
WITH n AS (SELECT 'https://news.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) AS source_url, text, n_chars FROM documents),
r AS ({S.routes_sql("(SELECT 'news' AS source_id)")})
SELECT 'document' AS outcome, source_url, project_id, text, CAST(NULL AS VARCHAR) AS reason FROM n, r WHERE n_chars <= 3000
UNION ALL SELECT 'reject', source_url, NULL, NULL, 'no text block' FROM n WHERE n_chars > 3000""")
def news_ingest(spark, sf_dir):
    """C4 article side to the corpus (P8, P3, P5, J5): the first text block of
    every fetched article goes through ingest, which numbers the items itself;
    pages without a block are rejected."""
    items, rejects = ex.news_items(_news_pages(spark, sf_dir), F.lit(NEWS_TIME).cast("timestamp"))
    routes = S.routes_for(spark.createDataFrame([("news",)], "source_id string"))
    return _outcome(ing.ingest(items, None, routes, run_ts=F.lit(NEWS_TIME).cast("timestamp")), rejects)


@query("review_ingest", sql=f"""
WITH b AS ({REVIEW_STATUS_SQL}), r AS ({S.routes_sql("(SELECT 'reviews' AS source_id)")})
SELECT 'document' AS outcome, source_url, project_id, body AS text, CAST(NULL AS VARCHAR) AS reason FROM b, r WHERE status = 'ok'
UNION ALL SELECT 'reject', page_url, NULL, NULL, status FROM b WHERE status <> 'ok'""")
def review_ingest(spark, sf_dir):
    """C4 reviews to the corpus (N6, P14, F4, F5): several documents per page,
    no time, numbered by ingest; blocks without headline or id are rejected."""
    items, rejects = ex.review_items(review_pages(spark, sf_dir))
    routes = S.routes_for(spark.createDataFrame([("reviews",)], "source_id string"))
    return _outcome(ing.ingest(items, None, routes, run_ts=F.lit(NEWS_TIME).cast("timestamp")), rejects)


# --- C5: the dictionary source ------------------------------------------------------

# Where each index page lists its items (see dictionary_pages).
ITEMS_PER_INDEX_PAGE = 50


def _index_pages(spark, sf_dir):
    """Index pages over the parts: ``ITEMS_PER_INDEX_PAGE`` items of one type
    per page; the data-set pages form a binary tree of not-ready branches."""
    p = S.table(spark, sf_dir, "part")
    typ = F.element_at(F.array(*[F.lit(x) for x in LINK_CLASSES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    dirs = F.create_map(*[x for kv in INDEX_DIRS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    p = p.select("p_partkey", typ.alias("item_type")).withColumn("page", F.expr(f"p_partkey div {5 * ITEMS_PER_INDEX_PAGE}"))
    href = F.concat(F.lit("/"), dirs[F.col("item_type")], F.lit("/p"), F.col("p_partkey").cast("string"), F.lit(".html"))
    anchor = (F.when(F.col("item_type") == "dataSet", F.concat(
                  F.lit('<li><span data-state="leaf"><span class="title"><a href="'), href, F.lit("#top\">d</a></span></span></li>")))
              .otherwise(F.concat(F.lit('<a class="'), F.col("item_type"), F.lit('" href="'), href, F.lit('">i</a>'))))
    g = (p.groupBy("item_type", "page")  # one bounded group per index page
         .agg(F.array_join(F.array_sort(F.collect_list(F.struct("p_partkey", anchor.alias("a"))))["a"], "").alias("body")))
    url = F.concat(F.lit(DICT_SITE), F.lit("index/"), F.col("item_type"), F.lit("/"), F.col("page").cast("string"), F.lit(".html"))
    containers = F.create_map(*[x for kv in dp.INDEX_CONTAINERS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])

    def branch(k):
        return F.concat(F.lit('<li><span data-state="not-ready"><span class="title"><a id="data_sets.'), k.cast("string"),
                        F.lit('" href="'), k.cast("string"), F.lit('.html">b</a></span></span></li>'))

    tree = F.concat(F.lit('<html><body><ul role="tree">'), F.col("body"), branch(F.col("page") * 2 + 1),
                    branch(F.col("page") * 2 + 2), F.lit("</ul></body></html>"))
    flat = F.concat(F.lit('<html><body><article id="'), containers[F.col("item_type")], F.lit('"><article>'),
                    F.col("body"), F.lit("</article></article></body></html>"))
    return g.select(url.alias("url"), "item_type",
                    F.when(F.col("item_type") == "dataSet", tree).otherwise(flat).alias("html"))


@query("dictionary_source", sql=f"""
SELECT t AS item_type, count(*) AS n_items,
       CAST(sum(1 + CASE WHEN t = 'element' THEN 1 ELSE 0 END + CASE WHEN t = 'class' THEN 2 ELSE 0 END) AS BIGINT)
         AS n_links
FROM (SELECT *, {TYPES_SQL}[CAST(p_partkey % 5 + 1 AS INTEGER)] AS t FROM part) GROUP BY t""")
def dictionary_source(spark, sf_dir):
    """C5 (S9, P12, F3, N5, J8, X4, U2, U3): index pages -> item ids (the
    data-set tree walked from its first page) -> fetched item pages ->
    dictionary items and links through the ingest job."""
    index_pages = _index_pages(spark, sf_dir)
    seeds = ex.seeds(spark, {"dataSet": [DICT_SITE + "index/dataSet/0.html"]}).withColumnRenamed("source_id", "item_type")
    item_pages = _dictionary_pages(spark, sf_dir).withColumnRenamed("source_url", "url")
    items, _ = ex.dictionary_items(index_pages, item_pages, seeds)
    res = ing.ingest(items, None, spark.createDataFrame([], "source_id string, project_id long, dataset_id long"))
    n_items = res.dictionary.groupBy("item_type").agg(F.count(F.lit(1)).alias("n_items"))
    n_links = res.links.groupBy(F.col("src_item_type").alias("item_type")).agg(F.count(F.lit(1)).alias("n_links"))
    return n_items.join(n_links, "item_type", "left").select(
        "item_type", "n_items", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
