"""Named queries: page links, ids, dictionary upsert and the link graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.text import LINK_CLASSES, extract_item_id, index_item_id, link_type
from quire.operators import dictionary as dct
from quire.operators import links as lk
from quire.plans import standins as S
from quire.plans.registry import query

ANCHORS_SQL = f"""
SELECT page_id, url, unnest(range(len(hs))) AS pos, unnest(hs) AS href
FROM (SELECT page_id, url, {lk.anchors_sql('html')} AS hs FROM pages)"""


@query("page_links", sql=f"""
SELECT page_id, url, pos, href, {lk.resolve_url_sql('url', 'href')} AS abs_url
FROM ({ANCHORS_SQL})""")
def page_links(spark, sf_dir):
    """Every anchor of every page with its absolute URL."""
    return lk.page_links(S.table(spark, sf_dir, "pages"))


# Links allowed into the frontier: same-site single-word paths.
ALLOW = r"^https?://[^/]+/[A-Za-z]+$"
NAV_REGION = r"(?is)<nav(?:\s[^>]*)?>(.*?)</nav\s*>"


@query("allowed_links", sql=f"""
WITH a AS (
  SELECT page_id, url, unnest(range(len(hs))) AS pos, unnest(hs) AS href
  FROM (SELECT page_id, url, {lk.anchors_sql(f"array_to_string(regexp_extract_all(html, '{NAV_REGION}', 1), '')")} AS hs
        FROM pages)),
r AS (SELECT page_id, pos, {lk.resolve_url_sql('url', 'href')} AS abs_url FROM a),
k AS (SELECT * FROM r WHERE regexp_matches(abs_url, '{ALLOW}'))
SELECT abs_url AS url, page_id, pos, n_refs FROM (
  SELECT *, row_number() OVER (PARTITION BY abs_url ORDER BY page_id, pos) AS rk,
         count(*) OVER (PARTITION BY abs_url) AS n_refs FROM k)
WHERE rk = 1""")
def allowed_links(spark, sf_dir):
    """Links of the navigation region matching the allow pattern,
    one row per URL (first page/position seen, reference count)."""
    links = lk.page_links(S.table(spark, sf_dir, "pages"), region_tag="nav")
    return lk.first_seen(lk.allowed(links, ALLOW))


# Index folders of the dictionary source, per item type.
INDEX_DIRS = {
    "element": "data_elements",
    "attribute": "attributes",
    "class": "classes",
    "businessDefinition": "nhs_business_definitions",
    "dataSet": "data_sets",
}


def _dir_sql(t: str) -> str:
    return "CASE " + " ".join(f"WHEN {t} = '{k}' THEN '{v}'" for k, v in INDEX_DIRS.items()) + " END"


def _types_sql() -> str:
    return "[" + ", ".join(f"'{x}'" for x in LINK_CLASSES) + "]"


def _index_items(spark, sf_dir):
    a = lk.page_links(S.table(spark, sf_dir, "pages"))
    word = F.regexp_extract("href", r"^/(.*)$", 1)
    typ = F.element_at(F.array(*[F.lit(x) for x in LINK_CLASSES]), (F.col("pos") % 5 + 1).cast("int"))
    dirs = F.create_map(*[x for kv in INDEX_DIRS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    a = a.withColumn("word", word).withColumn("item_type", typ)
    suffix = (F.when(F.col("word").contains(","), F.lit(""))
              .when(F.col("item_type") == "dataSet", F.concat(F.lit(".html#"), F.col("word")))
              .otherwise(F.lit(".html")))
    return a.withColumn("index_href", F.concat(F.lit("/"), dirs[F.col("item_type")], F.lit("/"),
                                               F.col("word"), suffix))


INDEX_ITEMS_SQL = f"""
SELECT page_id, pos, item_type, '/' || ({_dir_sql('item_type')}) || '/' || word ||
       CASE WHEN contains(word, ',') THEN '' WHEN item_type = 'dataSet' THEN '.html#' || word
            ELSE '.html' END AS index_href
FROM (SELECT page_id, pos, regexp_extract(href, '^/(.*)$', 1) AS word,
             {_types_sql()}[CAST(pos % 5 + 1 AS INTEGER)] AS item_type
      FROM ({ANCHORS_SQL}))"""


def _index_id_sql(h: str, t: str) -> str:
    from quire.functions.text import INDEX_ID_PATTERNS
    return ("CASE " + " ".join(f"WHEN {t} = '{k}' THEN regexp_extract({h}, '{v}', 1)"
                               for k, v in INDEX_ID_PATTERNS.items()) + " ELSE '' END")


@query("link_ids", sql=f"""
SELECT page_id, pos, item_type, index_href,
       {_index_id_sql('index_href', 'item_type')} AS item_id,
       regexp_extract(index_href, '(?:^|/)([^/]+).html$', 1) AS page_item_id,
       CASE WHEN {_index_id_sql('index_href', 'item_type')} = '' THEN 'rejected' ELSE 'ok' END AS status
FROM ({INDEX_ITEMS_SQL})""")
def link_ids(spark, sf_dir):
    """Ids from index hrefs; non-matching hrefs are rejected."""
    a = _index_items(spark, sf_dir)
    iid = index_item_id("index_href", "item_type")
    return a.select("page_id", "pos", "item_type", "index_href", iid.alias("item_id"),
                    extract_item_id("index_href").alias("page_item_id"),
                    F.when(iid == "", F.lit("rejected")).otherwise(F.lit("ok")).alias("status"))


# --- dictionary upsert: parts as typed items ------------------------------------

def _part_items(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    return p.select(
        F.col("p_brand").alias("item_type"), F.col("p_name").alias("item_id"),
        F.col("p_type").alias("name"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("description"),
        F.struct(F.concat("p_type", F.lit("/"), F.col("p_size").cast("string")).alias("format")).alias("meta"),
        F.col("p_partkey").alias("seq"), "p_size")


PART_ITEMS_SQL = """
SELECT p_brand AS item_type, p_name AS item_id, p_type AS name,
       'size ' || CAST(p_size AS VARCHAR) AS description,
       CAST(to_json({'format': p_type || '/' || CAST(p_size AS VARCHAR)}) AS VARCHAR) AS meta,
       p_partkey AS seq, p_size
FROM part"""


def _latest_sql(src: str) -> str:
    return f"""SELECT item_type, item_id, name, description, meta FROM (
  SELECT *, row_number() OVER (PARTITION BY item_type, item_id ORDER BY seq DESC) AS rk FROM ({src}))
WHERE rk = 1"""


@query("dictionary_upsert", sql=f"""
WITH b1 AS ({_latest_sql(f'SELECT * FROM ({PART_ITEMS_SQL}) WHERE p_size <= 25')}),
     b2 AS ({_latest_sql(f'SELECT * FROM ({PART_ITEMS_SQL}) WHERE p_size > 25')})
SELECT * FROM b1 WHERE NOT EXISTS (
  SELECT 1 FROM b2 WHERE b2.item_type = b1.item_type AND b2.item_id = b1.item_id)
UNION ALL SELECT * FROM b2""")
def dictionary_upsert(spark, sf_dir):
    """Two batches upserted in turn; the later batch and, within a batch,
    the later item win."""
    items = _part_items(spark, sf_dir)
    d1 = dct.upsert(None, items.where("p_size <= 25"))
    return dct.upsert(d1, items.where("p_size > 25"))


# --- link graph over orders and parts -----------------------------------------

CUTOFF = "2000-01-01"


def _order_edges(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "R", F.lit("returned")).otherwise(F.lit("contains")).alias("link_type"),
        F.lit("order").alias("src_item_type"), F.col("l_orderkey").cast("string").alias("src_item_id"),
        F.lit("part").alias("dst_item_type"), F.col("l_partkey").cast("string").alias("dst_item_id"))


E1_SQL = """
SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'contains' END AS link_type,
       'order' AS src_item_type, CAST(l_orderkey AS VARCHAR) AS src_item_id,
       'part' AS dst_item_type, CAST(l_partkey AS VARCHAR) AS dst_item_id
FROM lineitem"""


@query("link_replace", sql=f"""
WITH e1 AS ({E1_SQL}),
t2 AS (SELECT 'order' AS src_item_type, CAST(o_orderkey AS VARCHAR) AS src_item_id
       FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'),
e2 AS (SELECT 'open' AS link_type, 'order' AS src_item_type, CAST(l_orderkey AS VARCHAR) AS src_item_id,
              'part' AS dst_item_type, CAST(l_partkey AS VARCHAR) AS dst_item_id
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE o_orderdate >= TIMESTAMP '{CUTOFF}' AND l_linestatus = 'O')
SELECT * FROM e1 WHERE NOT EXISTS (
  SELECT 1 FROM t2 WHERE t2.src_item_type = e1.src_item_type AND t2.src_item_id = e1.src_item_id)
UNION ALL SELECT * FROM e2""")
def link_replace(spark, sf_dir):
    """Order->part edges; a later batch of recent orders replaces
    their edges with the open lines only (orders without any lose theirs)."""
    e1 = _order_edges(spark, sf_dir)
    orders = S.table(spark, sf_dir, "orders")
    recent = orders.where(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    t2 = recent.select(F.lit("order").alias("src_item_type"),
                       F.col("o_orderkey").cast("string").alias("src_item_id"))
    li = S.table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "O")
    e2 = (li.join(recent.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
          .select(F.lit("open").alias("link_type"), F.lit("order").alias("src_item_type"),
                  F.col("l_orderkey").cast("string").alias("src_item_id"),
                  F.lit("part").alias("dst_item_type"), F.col("l_partkey").cast("string").alias("dst_item_id")))
    g1 = dct.replace_edges(None, None, e1)
    return dct.replace_edges(g1, t2, e2)


def _graph_dictionary(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(
        F.lit("order").alias("item_type"), F.col("o_orderkey").cast("string").alias("item_id"),
        F.col("o_orderpriority").alias("name"))
    p = S.table(spark, sf_dir, "part").where(F.col("p_size") <= 25).select(
        F.lit("part").alias("item_type"), F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("name"))
    return o.unionByName(p)


@query("link_integrity", sql=f"""
WITH e AS ({E1_SQL}),
d AS (SELECT 'order' AS item_type, CAST(o_orderkey AS VARCHAR) AS item_id, o_orderpriority AS name
      FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_size <= 25)
SELECT e.*, d2.name AS dst_name, d2.item_id IS NOT NULL AS resolved
FROM e LEFT JOIN d d2 ON d2.item_type = e.dst_item_type AND d2.item_id = e.dst_item_id
WHERE EXISTS (SELECT 1 FROM d WHERE d.item_type = e.src_item_type AND d.item_id = e.src_item_id)""")
def link_integrity(spark, sf_dir):
    """Edges whose source exists, with destination resolved or not."""
    d = _graph_dictionary(spark, sf_dir)
    e = dct.links_with_source(_order_edges(spark, sf_dir), d)
    return dct.resolve_links(e, d)


@query("distinct_links", sql="""
SELECT CAST(l_orderkey AS VARCHAR) AS src_item_id,
       CASE WHEN l_quantity >= 25 THEN 'key_attribute' ELSE 'attribute' END AS link_type,
       'status' AS item_type, l_returnflag || l_linestatus AS item_id,
       min(l_linenumber) AS first_pos, count(*) AS n
FROM lineitem GROUP BY ALL""")
def distinct_links(spark, sf_dir):
    """Distinct links per order (whole struct as key) with their
    first-seen position - row form, so no order is gathered into an array."""
    li = S.table(spark, sf_dir, "lineitem")
    link = F.struct(link_type(F.col("l_quantity") >= 25).alias("link_type"),
                    F.lit("status").alias("item_type"),
                    F.concat("l_returnflag", "l_linestatus").alias("item_id"))
    g = (li.groupBy(F.col("l_orderkey").cast("string").alias("src_item_id"), link.alias("l"))
         .agg(F.min("l_linenumber").alias("first_pos"), F.count(F.lit(1)).alias("n")))
    return g.select("src_item_id", "l.*", "first_pos", "n")
