"""Named queries over pages built from the driver tables: reviews, ordered
release, nested JSON articles, index pages, tables, response status."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.markup import strip_tags, strip_tags_sql
from quire.functions.text import COMMENT_ID_PATTERN, TRIM_PATTERN, comment_id, content_key, trim_ws
from quire.operators import links as lk
from quire.operators.ordering import ordered_release as release
from quire.plans import standins as S
from quire.plans.registry import query
from quire.sources import html_pages as hp
from quire.sources import jsonpages as jp

HEADLINE = r"^([^.!?\n]*)"
REVIEW_SITE = "https://reviews.example.org/p/"


def _trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '{TRIM_PATTERN}', '', 'g')"


# --- review pages: several documents per page ------------------------------------

@query("comment_ids", sql=f"""
SELECT conv_id, turn, cid AS comment_id, doc_url, review_text,
       doc_url || '#' || md5(review_text) AS content_key
FROM (SELECT conv_id, turn, cid, '{REVIEW_SITE}' || CAST(conv_id AS VARCHAR) || '#' || cid AS doc_url,
             {_trim_sql(f"regexp_extract(text, '{HEADLINE}', 1)")} || '. ' || text AS review_text
      FROM (SELECT *, regexp_extract(CASE WHEN role = 'system' THEN 'report?comment=' || CAST(conv_id AS VARCHAR)
                      ELSE 'report?commentID=' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END,
                      '{COMMENT_ID_PATTERN}', 1) AS cid
            FROM conversations))
WHERE cid <> ''""")
def comment_ids(spark, sf_dir):
    """Comment id from a report link, review text = headline +
    '. ' + body, document URL = page URL + '#' + id, content-hash key."""
    c = S.table(spark, sf_dir, "conversations")
    link = (F.when(F.col("role") == "system", F.concat(F.lit("report?comment="), F.col("conv_id").cast("string")))
            .otherwise(F.concat(F.lit("report?commentID="), F.col("conv_id").cast("string"), F.lit("-"),
                                F.col("turn").cast("string"))))
    c = c.withColumn("comment_id", comment_id(link)).where(F.col("comment_id") != "")
    review = F.concat(trim_ws(F.regexp_extract("text", HEADLINE, 1)), F.lit(". "), F.col("text"))
    doc_url = F.concat(F.lit(REVIEW_SITE), F.col("conv_id").cast("string"), F.lit("#"), F.col("comment_id"))
    out = c.select("conv_id", "turn", "comment_id", doc_url.alias("doc_url"), review.alias("review_text"))
    return out.withColumn("content_key", content_key("doc_url", "review_text"))


def review_pages(spark, sf_dir):
    """One review page per conversation; each turn is one review block.
    System turns have no headline; short turns have no comment id."""
    c = S.table(spark, sf_dir, "conversations")
    head = trim_ws(F.regexp_extract("text", HEADLINE, 1))
    href = F.when(F.length("text") < 80, F.lit("report")).otherwise(
        F.concat(F.lit("report?commentID="), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")))
    block = F.concat(
        F.lit('<div class="card x" aria-label="Organisation review"><div data-n="1"><h3 class="h"><span class="v">Rated <b>4 stars</b>'),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.concat(F.lit(" "), head, F.lit(" "))),
        F.lit('</span></h3><p class="a">r1</p><div><p>not counted</p></div><p>r2</p><p>r3</p><p lang="x">'), F.col("text"),
        F.lit('</p><p>r5</p><p id="last">see <a class="r" href="'), href, F.lit('">Report</a></p></div></div>'))
    pages = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))).alias("bs"))
    return pages.select(
        F.col("conv_id").alias("page_id"),
        F.concat(F.lit(REVIEW_SITE), F.col("conv_id").cast("string")).alias("url"),
        F.concat(F.lit('<html><body><p>not here</p><main id="m">'), F.array_join(F.transform("bs", lambda x: x["b"]), ""),
                 F.lit("</main></body></html>")).alias("html"))


REVIEW_STATUS_SQL = f"""
SELECT conv_id, turn, '{REVIEW_SITE}' || CAST(conv_id AS VARCHAR) AS page_url,
       '{REVIEW_SITE}' || CAST(conv_id AS VARCHAR) || '#' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS source_url,
       head || '. ' || text AS body,
       CASE WHEN role = 'system' THEN 'no headline' WHEN length(text) < 80 THEN 'no comment id' ELSE 'ok' END AS status
FROM (SELECT *, {_trim_sql(f"regexp_extract(text, '{HEADLINE}', 1)")} AS head FROM conversations)"""


@query("multi_doc_pages", sql=f"""
SELECT conv_id AS page_id, turn AS block_no, CASE WHEN status = 'ok' THEN source_url END AS source_url,
       CASE WHEN status = 'ok' THEN body END AS text, status FROM ({REVIEW_STATUS_SQL})""")
def multi_doc_pages(spark, sf_dir):
    """Review blocks of each page become documents; blocks without
    headline or comment id are rejected with a reason."""
    reviews = hp.review_blocks(review_pages(spark, sf_dir))
    return reviews.select("page_id", "block_no", "source_url",
                          strip_tags("html").alias("text"), "status")


# --- character references ----------------------------------------------------------

@query("references_text", sql="SELECT doc_id, text FROM documents")
def references_text(spark, sf_dir):
    """documents written with character references of every form (named,
    legacy names without ';', decimal, hexadecimal, leading zeros) come back
    as they were; the expected text is the table's own."""
    d = S.table(spark, sf_dir, "documents")
    out = F.replace(F.col("text"), F.lit("&"), F.lit("&amp;"))
    for char, ref in (("<", "&lt;"), (",", "&comma;"), (".", "&period;"), ("é", "&eacute;"), ("ß", "&szlig;"), ("ñ", "&#241;"),
                      ("ó", "&#xF3;"), ("ä", "&#x000E4;"), ("ç", "&#00231;"), ("!", "&excl;"), ("|", "&VerticalLine;")):
        out = F.replace(out, F.lit(char), F.lit(ref))
    out = F.regexp_replace(F.regexp_replace(out, "ü(?!;)", "&uuml"), "ü", "&uuml;")
    return d.select("doc_id", strip_tags(F.concat(F.lit('<p title="a > b">'), out, F.lit("</p>"))).alias("text"))


# --- ordered release ---------------------------------------------------------------

ARRIVAL_SQL = "CAST(('0x' || substr(md5(CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR)), 1, 8)) AS BIGINT)"


def _arrivals(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    arrival = F.conv(F.substring(F.md5(F.concat(F.col("conv_id").cast("string"), F.lit("/"),
                                                F.col("turn").cast("string"))), 1, 8), 16, 10).cast("long")
    pos = F.when(F.col("role") == "system", F.col("turn") + 1).otherwise(F.col("turn"))
    return c.select(F.col("conv_id").alias("page_no"), pos.alias("position"), arrival.alias("arrival"), "turn")


TIED_ARRIVAL = 5


@query("ordered_release", sql=f"""
WITH it AS (SELECT conv_id AS page_no, CASE WHEN role = 'system' THEN turn + 1 ELSE turn END AS position,
                   {ARRIVAL_SQL} % {TIED_ARRIVAL} AS arrival, turn FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY page_no, position ORDER BY arrival, turn) AS place FROM it),
k AS (SELECT *, max(arrival) OVER w AS upto, count(*) OVER w AS n FROM f WHERE place = 1
      WINDOW w AS (PARTITION BY page_no ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT page_no, position, arrival, turn,
       CASE WHEN n = position + 1 THEN 'released' ELSE 'pending' END AS status,
       CASE WHEN n = position + 1 THEN upto END AS release_at
FROM k
UNION ALL
SELECT page_no, position, arrival, turn, 'rejected', CAST(NULL AS BIGINT) FROM f WHERE place > 1""")
def ordered_release(spark, sf_dir):
    """Conversation turns arrive shuffled and are released in
    position order; a system turn takes the next slot (collision -> the later
    arrival is rejected; its own slot stays empty -> later turns wait). Many
    arrivals are equal; the earlier turn then fills the slot."""
    a = _arrivals(spark, sf_dir)
    return release(a.withColumn("arrival", F.col("arrival") % TIED_ARRIVAL), tie=["turn"])


@query("conversation_text", sql="""
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text, count(*) AS n_turns
FROM conversations GROUP BY conv_id""")
def conversation_text(spark, sf_dir):
    """A3: text pieces of one document concatenated in order (the result is
    one value per document, so the pieces of a document meet in one row)."""
    c = S.table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("p"),
                                 F.count(F.lit(1)).alias("n_turns"))
    return g.select("conv_id", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), "n_turns")


# --- index pages (JSON) -----------------------------------------------------------------

def _index_pages(spark, sf_dir):
    p = S.table(spark, sf_dir, "pages")
    rel = F.array(
        F.struct(F.lit("Previous Page").alias("name"), F.col("url").alias("url")),
        F.struct(F.lit("Next Page").alias("name"), F.concat("url", F.lit("&next=1")).alias("url")),
        F.struct(F.lit("Next Page").alias("name"), F.lit("http://second.example.org/").alias("url")))
    sig = F.transform(lk.anchors("html"), lambda h: F.struct(
        F.when(F.length(h) > 4, F.lit("Result")).otherwise(F.lit("Other")).alias("linkRelationship"),
        h.alias("url")))
    return p.select("page_id", F.to_json(F.struct(rel.alias("relatedLink"), sig.alias("significantLink"))).alias("body"))


@query("result_links", sql=f"""
WITH a AS (SELECT page_id, url, list_filter({lk.anchors_sql('html')},
                                         lambda h: length(h) > 4) AS rs FROM pages)
SELECT page_id, 'item' AS kind, pos AS position, r AS url, -pos AS priority, url || '&next=1' AS next_page
FROM (SELECT page_id, url, unnest(range(len(rs))) AS pos, unnest(rs) AS r FROM a)
UNION ALL
SELECT page_id, 'index', CAST(NULL AS BIGINT), url || '&next=1', 0, CAST(NULL AS VARCHAR) FROM a WHERE len(rs) = 0""")
def result_links(spark, sf_dir):
    """Index JSON -> result requests with position and
    priority, or the first next-page request when a page has no results."""
    return jp.parse_index(_index_pages(spark, sf_dir), keys=["page_id"])


# --- nested article JSON ----------------------------------------------------------------

def _articles(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations")
    par = c.where(F.col("turn") % 2 == 0).select("conv_id", "turn", "text")
    ch = c.where(F.col("turn") % 2 == 1).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ctext"), F.col("role").alias("crole"))
    j = par.join(ch, ["conv_id", "turn"], "left")
    child = F.struct(F.when(F.col("crole") == "assistant", F.lit("markdown")).otherwise(F.lit("note")).alias("name"),
                     F.col("ctext").alias("text"), F.lit("see-also").alias("mainEntityOfPage"))
    kids = F.when(F.col("ctext").isNotNull(), F.array(child)).otherwise(
        F.array().cast("array<struct<name:string,text:string,mainEntityOfPage:string>>"))
    node = F.struct(F.lit("markdown").alias("name"), F.col("text").alias("text"), kids.alias("mainEntityOfPage"))
    g = j.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", node.alias("n")))).alias("ns"))
    day = F.lpad(((F.col("conv_id") % 28) + 1).cast("string"), 2, "0")
    body = F.to_json(F.struct(F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00+00:00")).alias("dateModified"),
                              F.transform("ns", lambda x: x["n"]).alias("mainEntityOfPage")))
    return g.select("conv_id", F.lit(200).alias("status"), body.alias("body"))


@query("markdown_text", sql="""
SELECT conv_id, CAST('2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00' AS TIMESTAMP)
         AS modified_at,
       string_agg(text, '' ORDER BY turn) FILTER (WHERE turn % 2 = 0 OR role = 'assistant') AS text
FROM conversations GROUP BY conv_id""")
def markdown_text(spark, sf_dir):
    """Text of the markdown nodes of nested article JSON,
    depth first; inner string values are not descended."""
    a = jp.parse_article(_articles(spark, sf_dir))
    return a.select("conv_id", F.col("modified_at").cast("timestamp_ntz").alias("modified_at"),
                    F.col("html").alias("text"))


# --- tables in markup -----------------------------------------------------------------

@query("table_rows", sql=f"""
SELECT conv_id, turn, row_no, {_trim_sql('line')} AS context, CAST(row_no AS VARCHAR) AS alias
FROM (SELECT conv_id, turn, unnest(range(len(ls))) AS row_no, unnest(ls) AS line
      FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS ls FROM conversations))""")
def table_rows(spark, sf_dir):
    """Table markup (one row per text line) to an array of
    typed row structs, shown exploded."""
    c = S.table(spark, sf_dir, "conversations")
    rows = F.transform(F.split("text", "\n", -1), lambda l, i: F.concat(
        F.lit("<tr><td> "), l, F.lit(" </td><td>"), i.cast("string"), F.lit("</td></tr>")))
    html = F.concat(F.lit("<table><tbody>"), F.array_join(rows, ""), F.lit("</tbody></table>"))
    t = c.select("conv_id", "turn", hp.extract_table(html, ["context", "alias"]).alias("rows"))
    return (t.select("conv_id", "turn", F.posexplode("rows").alias("row_no", "r"))
            .select("conv_id", "turn", F.col("row_no").cast("long").alias("row_no"), "r.context", "r.alias"))


# --- responses joined to pages ---------------------------------------------------------

ARTICLE = r"(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>"


@query("status_and_empty", sql=f"""
WITH t AS MATERIALIZED (
  SELECT page_id, url, {strip_tags_sql("article")} AS text
  FROM (SELECT page_id, url, array_to_string(regexp_extract_all(html, '{ARTICLE}', 1), '') AS article FROM pages)),
e AS (SELECT event_id, user_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 200
                                     WHEN event_type = 'signup' THEN 404 ELSE 500 END AS status FROM events)
SELECT event_id, page_id, url, status, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5
FROM e JOIN t ON page_id = user_id WHERE status = 200 AND text <> ''""")
def status_and_empty(spark, sf_dir):
    """Responses carry their request's fields; only status 200
    yields text (from the article region); empty items dropped."""
    e = S.table(spark, sf_dir, "events")
    p = S.table(spark, sf_dir, "pages")
    status = (F.when(F.col("event_type").isin("click", "view", "purchase"), 200)
              .when(F.col("event_type") == "signup", 404).otherwise(500))
    r = e.select("event_id", F.col("user_id").alias("page_id"), status.alias("status"))
    # Markup is stripped once per page, below the join: a page is fetched by
    # many requests, and only its text's length and digest travel to them.
    texts = (p.select("page_id", "url", strip_tags(lk.region("html", "article")).alias("text")).where("text <> ''")
             .select("page_id", "url", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5")))
    return (r.where("status = 200").join(texts, "page_id")
            .select("event_id", "page_id", "url", "status", "n_chars", "text_md5"))
