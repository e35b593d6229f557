"""Named queries: routing, stores, bootstrap, frontier walk, dictionary pages, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.text import LINK_CLASSES, drop_class, type_in_id
from quire.operators import catalog as cat
from quire.operators import ingest as ing
from quire.operators.frontier import walk
from quire.operators.ordering import first_by
from quire.plans import standins as S
from quire.plans.registry import query
from quire.session import bounded_broadcast, scratch_path, spread
from quire.sinks import standoff
from quire.sources import dictionary_pages as dp

TYPES_SQL = "[" + ", ".join(f"'{x}'" for x in LINK_CLASSES) + "]"
TIN_SQL = ("CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in
                                 {"businessDefinition": "business_definition", "dataSet": "dataset"}.items())
           + " ELSE t END")


# --- mixed-kind feed ----------------------------------------------------------------

def _mixed_feed(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.lit("text").alias("kind"), F.col("source").alias("source_id"),
        F.concat(F.lit("doc://"), "source", F.lit("/"), F.md5("text")).alias("source_url"), "text")
    p = S.pages_feed(spark, sf_dir).withColumn("seq", F.col("seq") + 10_000_000)
    c = S.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn") + 20_000_000).alias("seq"), F.lit("chat").alias("kind"),
        F.lit("chat").alias("source_id"), F.concat(F.lit("chat://"), F.col("conv_id").cast("string")).alias("source_url"),
        "text")
    typ = F.element_at(F.array(*[F.lit(x) for x in LINK_CLASSES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    k = S.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 30_000_000).alias("seq"), F.lit("dictionary").alias("kind"),
        F.lit("dictionary").alias("source_id"), typ.alias("item_type"), F.col("p_name").alias("item_id"),
        F.col("p_type").alias("name"))
    k = k.withColumn("source_url", F.concat(F.lit("dict://"), type_in_id("item_type"), F.lit("/"), "item_id"))
    feed = None
    for part in (d, p, c, k):
        part = ing.conform(part)
        feed = part if feed is None else feed.unionByName(part)
    return feed


MIXED_SQL = f"""
SELECT doc_id AS seq, 'text' AS kind, 'doc://' || source || '/' || md5(text) AS source_url FROM documents
UNION ALL SELECT page_id + 10000000, 'html', url FROM pages
UNION ALL SELECT conv_id * 100 + turn + 20000000, 'chat', 'chat://' || CAST(conv_id AS VARCHAR) FROM conversations
UNION ALL SELECT p_partkey + 30000000, 'dictionary', 'dict://' || ({TIN_SQL}) || '/' || p_name
FROM (SELECT *, {TYPES_SQL}[CAST(p_partkey % 5 + 1 AS INTEGER)] AS t FROM part)"""


@query("route_items", sql=f"""
WITH f AS ({MIXED_SQL}),
k AS (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq) AS rn FROM f WHERE kind <> 'chat')
SELECT 'documents' AS target, count(*) AS n FROM k WHERE rn = 1 AND kind IN ('text', 'html')
UNION ALL SELECT 'dictionary', count(*) FROM k WHERE rn = 1 AND kind = 'dictionary'
UNION ALL SELECT 'dropped', count(*) FROM k WHERE rn > 1
UNION ALL SELECT 'passthrough', count(*) FROM f WHERE kind = 'chat'
UNION ALL SELECT 'rejected', 0""")
def route_items(spark, sf_dir):
    """One mixed feed (text, html, dictionary and an
    unknown kind) through ingest; rows per target."""
    feed = _mixed_feed(spark, sf_dir)
    routes = S.routes_for(feed.where(F.col("kind") != "chat"))
    res = ing.ingest(feed, None, routes, run_ts=F.lit(None).cast("timestamp"))
    rejects = res.rejects

    def n(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("target"), "n")

    return (n(res.documents, "documents")
            .unionByName(n(res.dictionary, "dictionary"))
            .unionByName(n(rejects.where(F.col("stage") == "ledger"), "dropped"))
            .unionByName(n(res.passthrough, "passthrough"))
            .unionByName(n(rejects.where(F.col("stage") == "classify"), "rejected")))


@query("attr_maps", sql="""
SELECT p_partkey, CAST(to_json(map_from_entries(list_filter(map_entries(
         MAP {'class': p_type, 'brand': p_brand, 'size': CAST(p_size AS VARCHAR)}), lambda e: e.key <> 'class')))
       AS VARCHAR) AS attrs,
       CASE WHEN nullif(trim(p_type), '') IS NULL THEN NULL
            ELSE CAST(to_json({'format': trim(p_type)}) AS VARCHAR) END AS meta
FROM part""")
def attr_maps(spark, sf_dir):
    """Attribute map without ``class``; meta JSON, null when
    every field is empty."""
    p = S.table(spark, sf_dir, "part")
    m = F.create_map(F.lit("class"), F.col("p_type"), F.lit("brand"), F.col("p_brand"),
                     F.lit("size"), F.col("p_size").cast("string"))
    fmt = F.nullif(F.trim("p_type"), F.lit(""))
    meta = F.when(fmt.isNotNull(), F.to_json(F.struct(fmt.alias("format"))))
    return p.select("p_partkey", F.to_json(drop_class(m)).alias("attrs"), meta.alias("meta"))


@query("first_by_priority", sql="""
SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate, n FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS rk,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
WHERE rk = 1""")
def first_by_priority(spark, sf_dir):
    """O3: first order per customer by priority, then date, then key."""
    o = S.table(spark, sf_dir, "orders")
    return first_by(o, ["o_custkey"], ["o_orderpriority", "o_orderdate", "o_orderkey"],
                    ["o_orderkey", "o_orderpriority", "o_orderdate"])


@query("csv_dataset", sql=f"""
WITH r AS ({S.routes_sql('(SELECT source AS source_id FROM documents)')})
SELECT r.dataset_id, 'doc-' || CAST(d.doc_id AS VARCHAR) AS name, d.text
FROM documents d JOIN r ON r.source_id = d.source""")
def csv_dataset(spark, sf_dir):
    """Documents written as CSV (quotes, commas, newlines),
    read back keeping name and text, stored per dataset, read back."""
    from quire.sources.files import read_dataset_csv, write_dataset_csv

    d = S.table(spark, sf_dir, "documents")
    csv_dir = scratch_path(spark, "csv")
    write_dataset_csv(d.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
                               "text", "lang", "source", "n_chars"), csv_dir)
    back = read_dataset_csv(spark, csv_dir)
    routes = S.routes_for(d.select(F.col("source").alias("source_id")))
    src = d.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
                   F.col("source").alias("source_id"))
    r, _ = bounded_broadcast(routes.select("source_id", "dataset_id"), ing.MAX_BROADCAST_ROUTES)
    rows = back.join(src, "name").join(r, "source_id")
    store = scratch_path(spark, "datasets")
    rows.select("dataset_id", "name", "text").write.mode("overwrite").partitionBy("dataset_id").parquet(store)
    return spark.read.parquet(store).select(F.col("dataset_id").cast("long").alias("dataset_id"), "name", "text")


EXISTING_PROJECTS_SQL = """
SELECT name, 100 + row_number() OVER (ORDER BY name) AS id FROM (
  SELECT DISTINCT d.source AS name FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1)"""


def _existing_projects(spark, sf_dir):
    from quire.operators.ids import sequential_ids

    d = S.table(spark, sf_dir, "documents")
    l = S.table(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    names = d.join(l, "doc_id", "left_semi").select(F.col("source").alias("name")).distinct()
    return sequential_ids(names, ["name"], start=101)


@query("projects_get_or_create", sql=f"""
WITH ex AS ({EXISTING_PROJECTS_SQL}),
req AS (SELECT DISTINCT source AS name FROM documents)
SELECT req.name, ex.id, FALSE AS created FROM req JOIN ex USING (name)
UNION ALL
SELECT name, (SELECT coalesce(max(id), 0) FROM ex) + row_number() OVER (ORDER BY name), TRUE
FROM req WHERE name NOT IN (SELECT name FROM ex)""")
def projects_get_or_create(spark, sf_dir):
    """A project per source name; existing names keep their ids."""
    names = S.table(spark, sf_dir, "documents").select(F.col("source").alias("name"))
    out = cat.projects_get_or_create(_existing_projects(spark, sf_dir), names)
    return out.select("name", "id", "created")


@query("project_bootstrap", sql=f"""
WITH ex AS ({EXISTING_PROJECTS_SQL}),
req AS (SELECT DISTINCT source AS name FROM documents),
p AS (SELECT req.name, ex.id, FALSE AS created FROM req JOIN ex USING (name)
      UNION ALL
      SELECT name, (SELECT coalesce(max(id), 0) FROM ex) + row_number() OVER (ORDER BY name), TRUE
      FROM req WHERE name NOT IN (SELECT name FROM ex))
SELECT *, 'SequenceLabeling' AS project_type, 'SequenceLabelingProject' AS resource_type,
       array_to_string(string_split_regex('{cat.EXAMPLE_TYPE_FILTER}', ',\\s*'), ',') AS filters,
       (SELECT count(*) = 0 FROM ex) AND (SELECT count(*) = 0 FROM labels) AS first_run
FROM p""")
def project_bootstrap(spark, sf_dir):
    """Projects with their settings (type, resource type,
    concept type filter split into a list), and whether this is a first run:
    every store that is there holds nothing."""
    names = S.table(spark, sf_dir, "documents").select(F.col("source").alias("name"))
    existing = _existing_projects(spark, sf_dir)
    cat.register(spark, {"corpus_projects": existing, "corpus_labels": S.table(spark, sf_dir, "labels")})
    out = cat.projects_get_or_create(existing, names, type_filter=cat.EXAMPLE_TYPE_FILTER)
    out = out.withColumn("first_run", F.lit(cat.first_run(spark, ["corpus_projects", "corpus_labels", "corpus_datasets"])))
    # the filter list, shown as text so both engines print it alike
    return out.withColumn("filters", F.array_join("filters", ","))


# --- frontier walk over a customer tree ---------------------------------------------

@query("frontier_walk", sql="""
WITH RECURSIVE e AS (
  SELECT c.c_custkey AS src, d.c_custkey AS dst FROM customer c
  JOIN customer d ON d.c_custkey = 2 * c.c_custkey + 1 OR d.c_custkey = 2 * c.c_custkey + 2
  UNION ALL
  SELECT c.c_custkey, d.c_custkey FROM customer c JOIN customer d ON d.c_custkey = c.c_custkey // 2
  WHERE c.c_mktsegment = 'BUILDING'),
w(node, depth) AS (
  SELECT min(c_custkey), 0 FROM customer
  UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node WHERE w.depth < 64)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY node""")
def frontier_walk(spark, sf_dir):
    """Breadth-first expansion from the first page along next links
    (a tree with back links - the walk never expands a node twice)."""
    c = S.table(spark, sf_dir, "customer")
    keys = c.select(F.col("c_custkey").alias("dst"))
    kids = c.select(F.col("c_custkey").alias("src"),
                    F.explode(F.array(F.col("c_custkey") * 2 + 1, F.col("c_custkey") * 2 + 2)).alias("dst"))
    back = c.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("src"), F.floor(F.col("c_custkey") / 2).cast("long").alias("dst"))
    edges = kids.unionByName(back).join(keys, "dst", "left_semi")
    seeds = c.agg(F.min("c_custkey").alias("node"))
    return walk(seeds, edges)


# --- dictionary pages built from parts -------------------------------------------------

DICT_SITE = "https://dictionary.example.org/"


def _dictionary_pages(spark, sf_dir):
    # a row becomes a page that is a hundred times its size: few bytes, much work
    p = spread(S.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size"), "p_partkey")
    k = F.col("p_partkey")
    ks = lambda x: x.cast("string")
    typ = F.element_at(F.array(*[F.lit(x) for x in LINK_CLASSES]), (k % 5 + 1).cast("int"))
    p = p.withColumn("item_type", typ).withColumn("tin", type_in_id("item_type")) \
         .withColumn("item_id", F.concat(F.lit("p"), ks(k)))
    key = F.concat(F.col("tin"), F.lit("_"), F.col("item_id"))
    art = lambda suffix, inner: F.concat(F.lit('<article id="'), key, F.lit(suffix), F.lit('"><div class="body">'),
                                         inner, F.lit("</div></article>"))
    section = F.when(F.col("item_type") == "dataSet", F.lit(".overview")).otherwise(F.lit(".description"))
    desc = F.concat(
        F.lit('<article id="'), key, section, F.lit('"><div class="body"><div class="d">Part '), F.col("p_name"),
        F.lit(' <a class="element" href="../data_elements/p'), ks(k + 1), F.lit('.html">next</a>, '),
        F.lit('<a class="x element" href="../data_elements/p'), ks(k + 1), F.lit('.html">again</a>, '),
        F.lit('<a class="'), F.col("item_type"), F.lit('" href="p'), ks(k), F.lit('.html">self</a>, '),
        F.lit('<a class="attribute" href="../attributes/p'), ks(k + 2), F.lit('.htm">bad</a>, '),
        F.lit('<a href="/ext/'), ks(k), F.lit('">ext</a><script>x()</script>tail</div></div></article>'))
    aka = F.when(F.col("p_size") > 25, art(".also_known_as", F.concat(
        F.lit("<table><tbody><tr><td> ctx </td><td>"), F.col("p_type"), F.lit("</td></tr></tbody></table>"))))
    attrs = F.when(F.col("item_type") == "class", art(".attributes", F.concat(
        F.lit('<table><tbody><tr><td>Key</td><td><a href="../attributes/k'), ks(k), F.lit('.html">k</a></td></tr>'),
        F.lit('<tr><td></td><td><a href="../attributes/n'), ks(k), F.lit('.html">n</a></td></tr></tbody></table>'))))
    attr = F.when(F.col("item_type") == "element", art(".attribute", F.concat(
        F.lit('<a class="attribute" href="../attributes/a'), ks(k), F.lit('.html">a</a>'))))
    fmt = F.when(k % 7 == 0, art(".format___length", F.concat(F.lit("<p> max "), ks(F.col("p_size")), F.lit(" </p>"))))
    html = F.concat(
        F.lit('<html><head><meta name="name" content="'), F.col("p_name"), F.lit('"></head><body><div id="wh_topic_body">'),
        desc, F.coalesce(aka, F.lit("")), F.coalesce(attrs, F.lit("")), F.coalesce(attr, F.lit("")),
        F.coalesce(fmt, F.lit("")), F.lit("</div></body></html>"))
    from quire.plans.graph import INDEX_DIRS

    dirs = F.create_map(*[x for kv in INDEX_DIRS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return p.select(
        F.concat(F.lit(DICT_SITE), dirs[F.col("item_type")], F.lit("/"), F.col("item_id"),
                 F.lit(".html")).alias("source_url"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Wed, 21 Oct 2015 07:28:00 GMT")).alias("last_modified"),
        "item_type", "item_id", html.alias("html"))


@query("dictionary_extract", sql=f"""
SELECT t AS item_type, 'p' || p AS item_id, p_name AS name,
       '<article>Part ' || p_name || ' <a data-item-type="element" data-item-id="p' || q || '">next</a>, <a data-item-type="element" data-item-id="p'
       || q || '">again</a>, <a data-item-type="' || t || '" data-item-id="p' || p
       || '">self</a>, <a data-item-type="attribute" data-item-id="">bad</a>, <a href="{DICT_SITE}ext/' || p || '">ext</a></article>' AS description,
       '-:element:p' || q || CASE WHEN t = 'element' THEN ' element_attribute:attribute:a' || p
         WHEN t = 'class' THEN ' key_attribute:attribute:k' || p || ' attribute:attribute:n' || p ELSE '' END AS links,
       CASE WHEN p_partkey % 7 = 0 THEN 'max ' || CAST(p_size AS VARCHAR) END AS format,
       CASE WHEN p_size > 25 THEN 'ctx=' || p_type END AS alias, p_size % 2 = 0 AS has_time, 'ok' AS status
FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS p, CAST(p_partkey + 1 AS VARCHAR) AS q, {TYPES_SQL}[CAST(p_partkey % 5 + 1 AS INTEGER)] AS t
      FROM part)""")
def dictionary_extract(spark, sf_dir):
    """Dictionary pages (built from parts)
    to typed items: the rewritten markup, every link, format and alias."""
    items = dp.extract_items(_dictionary_pages(spark, sf_dir))
    links = F.array_join(F.transform("links", lambda x: F.concat_ws(
        ":", F.coalesce(x["link_type"], F.lit("-")), x["item_type"], x["item_id"])), " ")
    alias = F.get("meta.aliases", F.lit(0))
    return items.select("item_type", "item_id", "name", "description", links.alias("links"), F.col("meta.format").alias("format"),
                        F.concat(alias["context"], F.lit("="), alias["alias"]).alias("alias"),
                        F.col("modified_at").isNotNull().alias("has_time"), "status")


RUN_TS = "2024-01-01 00:00:00"


@query("standoff_export", sql=f"""
SELECT doc_id, concat_ws('_', source, '20240101000000',
                         substr(md5(CAST(doc_id AS VARCHAR) || text), 1, 12)) AS file_name,
       CAST(length(text) AS BIGINT) AS n_chars
FROM documents""")
def standoff_export(spark, sf_dir):
    """A text file and an empty annotation file per document,
    written by the executors; the manifest is the result."""
    d = S.table(spark, sf_dir, "documents").withColumnRenamed("source", "source_id")
    target = scratch_path(spark, "standoff")
    return standoff.export(d, target, run_ts=F.lit(RUN_TS).cast("timestamp"))
