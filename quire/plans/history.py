"""Named queries: what changed, what agrees, what was found, and jobs that must lose nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions.spans import register_annotator
from quire.operators import annotate as an
from quire.operators import catalog as cat
from quire.operators import frontier as fr
from quire.operators import ingest as ing
from quire.operators import ledger as led
from quire.operators import revisions as rv
from quire.operators import terms as tm
from quire.operators.ordering import ordered_release
from quire.plans import standins as S
from quire.plans.annotation import TERM, TERMS, _spans_rows_sql
from quire.plans.corpus import LEDGER1_SQL, BATCH2_SQL, ledger_accept_sql
from quire.plans.graph import E1_SQL, _graph_dictionary, _order_edges
from quire.plans.pages import ARRIVAL_SQL, REVIEW_STATUS_SQL, TIED_ARRIVAL, _arrivals, review_pages
from quire.plans.registry import query
from quire.plans.sources import CONDITIONS_SITE, NEWS_TIME, _article_responses, _news_pages
from quire.session import keyed_filter, scratch_path
from quire.sinks.keyed import DictionaryStore
from quire.sources import extractors as ex
from quire.streaming import ingest as si
from quire.streaming import release as sr

# --- R1: line changes between versions ------------------------------------------------

VERSIONS_SQL = """
SELECT doc_id, 1 AS version, l1 AS lines FROM v UNION ALL SELECT doc_id, 2, l2 FROM v
UNION ALL SELECT doc_id, 3, list_concat(list_reverse(l2), [l1[1]]) FROM v"""
EDITED_SQL = """
SELECT doc_id, l1, list_concat(list_filter(l1[2:], lambda x: length(x) % 5 <> 0), [l1[1]], ['rev ' || CAST(doc_id AS VARCHAR)]) AS l2
FROM (SELECT doc_id, string_split(text, chr(10)) AS l1 FROM documents WHERE text IS NOT NULL)"""


def _versions(spark, sf_dir):
    """Three versions of every document: as it is; without some lines, its
    first line last and a new one behind it; those lines reversed."""
    d = S.table(spark, sf_dir, "documents").where("text IS NOT NULL")
    one = F.split("text", "\n", -1)
    d = d.select("doc_id", one.alias("l1"))
    two = F.concat(F.filter(F.slice("l1", 2, F.size("l1")), lambda x: F.length(x) % 5 != 0), F.slice("l1", 1, 1),
                   F.array(F.concat(F.lit("rev "), F.col("doc_id").cast("string"))))
    d = d.withColumn("l2", two)
    three = F.concat(F.reverse("l2"), F.slice("l1", 1, 1))
    texts = F.array(F.col("l1"), F.col("l2"), three)
    return (d.select("doc_id", F.posexplode(texts).alias("k", "lines"))
            .select("doc_id", (F.col("k") + 1).alias("version"), F.array_join("lines", "\n").alias("text")))


_COUNTED_SQL = f"""
WITH v AS MATERIALIZED ({EDITED_SQL}), a AS ({VERSIONS_SQL}),
c AS MATERIALIZED (SELECT doc_id, version, line, count(*) AS n FROM (SELECT doc_id, version, unnest(lines) AS line FROM a) GROUP BY ALL),
p AS (SELECT coalesce(o.doc_id, w.doc_id) AS doc_id, coalesce(o.version, w.version) AS version, coalesce(o.line, w.line) AS line,
             coalesce(o.n, 0) AS n_old, coalesce(w.n, 0) AS n_new
      FROM (SELECT * FROM c WHERE version < 3) o FULL JOIN (SELECT doc_id, version - 1 AS version, line, n FROM c WHERE version > 1) w
      ON o.doc_id = w.doc_id AND o.version = w.version AND o.line = w.line)"""


@query("change_audit", sql=_COUNTED_SQL + """
SELECT doc_id, version, CAST(sum(n_old) AS BIGINT) AS n_old, CAST(sum(n_new) AS BIGINT) AS n_new,
       CAST(sum(greatest(n_new - n_old, 0)) AS BIGINT) AS n_added, CAST(sum(greatest(n_old - n_new, 0)) AS BIGINT) AS n_removed,
       CAST(sum(least(n_old, n_new)) AS BIGINT) AS n_common, TRUE AS applies
FROM p GROUP BY ALL""")
def change_audit(spark, sf_dir):
    """What changed from each version of a document to the next; the
    changes applied to a version give the next one."""
    pairs = rv.compared(_versions(spark, sf_dir), key="doc_id")
    count = lambda op: F.size(F.filter("changes", lambda c: c["op"] == op)).cast("long")
    n_old, n_new = (F.size(F.split(c, "\n", -1)).cast("long") for c in ("old", "new"))
    return pairs.select("doc_id", "version", n_old.alias("n_old"), n_new.alias("n_new"), count("added").alias("n_added"),
                        count("removed").alias("n_removed"), (n_old - count("removed")).alias("n_common"),
                        rv.applied("old", "changes").eqNullSafe(F.col("new")).alias("applies"))


@query("changed_lines", sql=_COUNTED_SQL + """
SELECT doc_id, version, CASE WHEN n_new > n_old THEN 'added' ELSE 'removed' END AS op, line, abs(n_new - n_old) AS n FROM p WHERE n_new <> n_old""")
def changed_lines(spark, sf_dir):
    """The lines that came and went between versions, with their number;
    lines that only moved are none of them."""
    rows = rv.audit(rv.compared(_versions(spark, sf_dir), key="doc_id"), key="doc_id").where("op <> 'moved'")
    return rows.groupBy("doc_id", "version", "op", "line").agg(F.count(F.lit(1)).alias("n"))


# --- R6: terms of one to eight words ----------------------------------------------------

_WORD_SQL = r"\p{L}+"


@query("term_codes", sql=rf"""
WITH lw AS (SELECT item_id, regexp_extract_all(lower(text), '{_WORD_SQL}') AS w FROM benchmark),
lex AS MATERIALIZED (SELECT array_to_string(w[i:i + item_id % 8], ' ') AS term, min('B' || CAST(item_id AS VARCHAR)) AS code
        FROM (SELECT item_id, w, unnest(range(1, len(w) - item_id % 8 + 1)) AS i FROM lw)
        WHERE item_id % 8 > 0 OR length(w[i]) > 6 GROUP BY 1),
d AS (SELECT doc_id, regexp_split_to_array(text, '{_WORD_SQL}') AS gaps, regexp_extract_all(text, '{_WORD_SQL}') AS ws FROM documents),
u AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, unnest(gaps[1:len(ws)]) AS gap FROM d),
o AS MATERIALIZED (SELECT doc_id, i - 1 AS pos, lower(word) AS word, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY i) AS fin,
                          length(word) AS len FROM u),
dw AS (SELECT doc_id, list(word ORDER BY pos) AS w, list(fin ORDER BY pos) AS fins FROM o GROUP BY doc_id),
cand AS (SELECT o.doc_id, o.pos, n, array_to_string(w[o.pos + 1:o.pos + n], ' ') AS term, fin - len AS start_offset, fins[o.pos + n] AS end_offset
         FROM o JOIN dw USING (doc_id), range(1, 9) t(n) WHERE o.pos + n <= len(w)),
m AS MATERIALIZED (SELECT * FROM (SELECT c.*, code, row_number() OVER (PARTITION BY doc_id, pos ORDER BY n DESC) AS rk FROM cand c JOIN lex USING (term)) WHERE rk = 1),
kept AS (SELECT doc_id, unnest(list_reduce(list({{'upto': pos + n, 'at': [pos]}} ORDER BY pos), lambda a, x:
           CASE WHEN x['at'][1] >= a['upto'] THEN {{'upto': x['upto'], 'at': list_concat(a['at'], x['at'])}} ELSE a END)['at']) AS pos FROM m GROUP BY doc_id)
SELECT doc_id, pos, CAST(n AS INTEGER) AS n_words, CAST(start_offset AS BIGINT) AS start_offset, CAST(end_offset AS BIGINT) AS end_offset, term, code
FROM m JOIN kept USING (doc_id, pos)""")
def term_codes(spark, sf_dir):
    """Terms of one to eight words coded in every document, longest
    leftmost, with offsets. The code list: word runs of the benchmark items,
    of item i all runs of i % 8 + 1 words (single words of over six letters)."""
    b = S.table(spark, sf_dir, "benchmark").select("item_id", tm.words("text").alias("w"), (F.col("item_id") % 8 + 1).cast("int").alias("n"))
    runs = b.where(F.size("w") >= F.col("n")).select("item_id", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("term"))
    terms = runs.where((F.col("n") > 1) | (F.length("term") > 6)).select("term", F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("code"))
    return tm.coded(S.table(spark, sf_dir, "documents"), terms)


# --- R5 and R3: levels and agreement -------------------------------------------------------

SENTENCE_SPAN = r"([^.!?]+[.!?]*)"


@query("annotation_levels", sql=f"""
WITH s0 AS (SELECT doc_id, regexp_split_to_array(text, '{SENTENCE_SPAN}') AS gaps, regexp_extract_all(text, '{SENTENCE_SPAN}', 1) AS ss FROM documents),
s1 AS (SELECT doc_id, unnest(range(len(ss))) AS unit_no, unnest(ss) AS s, unnest(gaps[1:len(ss)]) AS gap FROM s0),
s AS MATERIALIZED (SELECT doc_id, unit_no, sum(length(gap) + length(s)) OVER (PARTITION BY doc_id ORDER BY unit_no) AS fin, length(s) AS n FROM s1),
t AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start_offset) - 1 AS unit_no FROM ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', TERMS)}))
SELECT doc_id, 'document' AS level, CAST(0 AS BIGINT) AS unit_no, CAST(0 AS BIGINT) AS start_offset, CAST(length(text) AS BIGINT) AS end_offset,
       CAST(NULL AS VARCHAR) AS label, CAST(NULL AS BIGINT) AS sent_no FROM documents WHERE text IS NOT NULL
UNION ALL SELECT doc_id, 'sentence', unit_no, CAST(fin - n AS BIGINT), CAST(fin AS BIGINT), NULL, unit_no FROM s
UNION ALL SELECT t.doc_id, 'term', t.unit_no, start_offset, end_offset, label, s.unit_no
FROM t LEFT JOIN s ON s.doc_id = t.doc_id AND s.fin - s.n <= start_offset AND end_offset <= s.fin""")
def annotation_levels(spark, sf_dir):
    """Document, sentence and term intervals with offsets; each term names its sentence."""
    return an.levels(S.table(spark, sf_dir, "documents"), SENTENCE_SPAN, TERMS)


# The second annotator also marks the terms at the start of longer words.
LOOSE_TERMS = r"\b(thing|this|that|with)"


@query("annotator_kappa", sql=f"""
WITH a AS (SELECT DISTINCT doc_id, label, unnest(range(start_offset, end_offset)) AS c FROM ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', TERMS)})),
b AS (SELECT DISTINCT doc_id, label, unnest(range(start_offset, end_offset)) AS c FROM ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', LOOSE_TERMS)})),
n AS (SELECT CAST(sum(length(text)) AS BIGINT) AS n FROM documents),
k AS (SELECT coalesce(a.label, b.label) AS label, count(a.c) AS na, count(b.c) AS nb, count(CASE WHEN a.c IS NOT NULL AND b.c IS NOT NULL THEN 1 END) AS n_both
      FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.label = b.label AND a.c = b.c GROUP BY 1),
f AS (SELECT *, n - na - nb + n_both AS n_neither, (na / n) * (nb / n) + (1 - na / n) * (1 - nb / n) AS chance FROM k, n)
SELECT label, n_both, na - n_both AS n_a_only, nb - n_both AS n_b_only, n_neither, ((n_both + n_neither) / n - chance) / (1 - chance) AS kappa FROM f""")
def annotator_kappa(spark, sf_dir):
    """Characters two annotators agree and disagree on, and kappa, per label."""
    d = S.table(spark, sf_dir, "documents")
    a = an.explode_spans(an.spans(d, pattern=TERMS), ["doc_id"])
    b = an.explode_spans(an.spans(d, pattern=LOOSE_TERMS), ["doc_id"])
    return an.agreement(a, b, d)


@query("annotate_terms_sql", sql=_spans_rows_sql("SELECT * FROM documents", "doc_id", TERM))
def annotate_terms_sql(spark, sf_dir):
    """The annotator called from SQL text, as a table function beside
    the view of the documents."""
    cat.register(spark, {"corpus_documents": S.table(spark, sf_dir, "documents").select("doc_id", "text")})
    register_annotator(spark)
    pattern = TERM.replace("\\", "\\\\")
    return spark.sql(f"SELECT d.doc_id, s.* FROM corpus_documents d, LATERAL span_rows(d.text, '{pattern}') s")


# --- N4: long chains of pages ----------------------------------------------------------------

CHAIN = 997


@query("page_chain", sql=f"""
SELECT event_id AS node, CAST(event_id % {CHAIN} AS INTEGER) AS depth FROM events WHERE (event_id // {CHAIN}) % 2 = 0""")
def page_chain(spark, sf_dir):
    """Chains of next-page links (events in order, cut every ``CHAIN``,
    each last page linking back to its first) walked by link doubling from
    every other first page."""
    e = S.table(spark, sf_dir, "events").select(F.col("event_id").alias("src"))
    last = F.col("src") % CHAIN == CHAIN - 1
    edges = e.select("src", F.when(last, F.col("src") - CHAIN + 1).otherwise(F.col("src") + 1).alias("dst"))
    edges = edges.join(e.select(F.col("src").alias("dst")), "dst", "left_semi")
    seeds = e.where((F.col("src") % CHAIN == 0) & (F.expr(f"src div {CHAIN}") % 2 == 0)).select(F.col("src").alias("node"))
    return fr.walk(seeds, edges)


# --- jobs that must lose nothing ----------------------------------------------------------------

UNNUMBERED_SQL = """
SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'doc://' || source || '/' || CAST(doc_id % 50 AS VARCHAR) END AS source_url,
       CASE WHEN doc_id % 11 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 7 AS INTEGER)) END AS modified_at,
       CASE WHEN lang = 'de' THEN 'chat' ELSE 'text' END AS kind, source AS source_id, min(text) AS text
FROM documents GROUP BY ALL"""


@query("ingest_unnumbered", sql=f"""
WITH i AS MATERIALIZED ({UNNUMBERED_SQL}),
f AS MATERIALIZED (SELECT row_number() OVER (ORDER BY modified_at NULLS FIRST, source_url) AS seq, * FROM i WHERE kind = 'text' AND source_url IS NOT NULL),
a AS MATERIALIZED ({ledger_accept_sql('SELECT * FROM f')})
SELECT 'document' AS outcome, source_url, count(*) AS n FROM a GROUP BY ALL
UNION ALL SELECT 'unchanged', source_url, count(*) FROM f WHERE seq NOT IN (SELECT seq FROM a) GROUP BY ALL
UNION ALL SELECT 'missing source_url', NULL, count(*) FROM i WHERE kind = 'text' AND source_url IS NULL HAVING count(*) > 0
UNION ALL SELECT 'passthrough', source_url, count(*) FROM i WHERE kind = 'chat' GROUP BY ALL""")
def ingest_unnumbered(spark, sf_dir):
    """Items without arrival numbers that come out of a shuffle; every
    one is stored, rejected or passed through, counted after all three are written."""
    d = S.table(spark, sf_dir, "documents")
    url = F.when(F.col("doc_id") % 13 != 0, F.concat(F.lit("doc://"), "source", F.lit("/"), (F.col("doc_id") % 50).cast("string")))
    time = F.when(F.col("doc_id") % 11 != 0, F.timestamp_add("DAY", (F.col("doc_id") % 7).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    items = (d.groupBy(url.alias("source_url"), time.alias("modified_at"), F.when(F.col("lang") == "de", "chat").otherwise("text").alias("kind"),
                       F.col("source").alias("source_id")).agg(F.min("text").alias("text")))
    res = ing.ingest(items, None, S.routes_for(d.select(F.col("source").alias("source_id"))), run_ts=F.lit(None).cast("timestamp"), trainer=False)
    path = scratch_path(spark, "unnumbered")
    res.documents.write.parquet(f"{path}/documents")
    res.rejects.write.parquet(f"{path}/rejects")
    res.passthrough.write.parquet(f"{path}/passthrough")
    read = lambda name, outcome, u: spark.read.parquet(f"{path}/{name}").select(outcome.alias("outcome"), F.col(u).alias("source_url"))
    rows = (read("documents", F.lit("document"), "source_url").unionByName(read("rejects", F.col("reason"), "url"))
            .unionByName(read("passthrough", F.lit("passthrough"), "source_url")))
    return rows.groupBy("outcome", "source_url").agg(F.count(F.lit(1)).alias("n"))


NULL_SLOTS_SQL = f"""
SELECT CASE WHEN conv_id % 7 = 3 AND turn = 1 THEN NULL ELSE conv_id END AS page_no,
       CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN NULL WHEN conv_id % 11 = 4 AND turn = 0 THEN -1
            WHEN role = 'system' THEN turn + 1 ELSE turn END AS position,
       {ARRIVAL_SQL} % {TIED_ARRIVAL} AS arrival, turn, conv_id FROM conversations"""


@query("release_null_slots", sql=f"""
WITH it AS ({NULL_SLOTS_SQL}),
ok AS (SELECT * FROM it WHERE page_no IS NOT NULL AND position >= 0),
f AS (SELECT *, row_number() OVER (PARTITION BY page_no, position ORDER BY arrival, turn) AS place FROM ok),
k AS (SELECT *, max(arrival) OVER w AS upto, count(*) OVER w AS n FROM f WHERE place = 1
      WINDOW w AS (PARTITION BY page_no ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT page_no, position, arrival, turn, conv_id, CASE WHEN n = position + 1 THEN 'released' ELSE 'pending' END AS status,
       CASE WHEN n = position + 1 THEN upto END AS release_at FROM k
UNION ALL SELECT page_no, position, arrival, turn, conv_id, 'rejected', CAST(NULL AS BIGINT) FROM f WHERE place > 1
UNION ALL SELECT page_no, position, arrival, turn, conv_id, 'rejected', NULL FROM it WHERE page_no IS NULL OR position IS NULL OR position < 0""")
def release_null_slots(spark, sf_dir):
    """Rows without page, without position or before the first slot
    are rejected, and hold up nothing that has a slot."""
    a = _arrivals(spark, sf_dir).withColumn("conv_id", F.col("page_no")).withColumn("arrival", F.col("arrival") % TIED_ARRIVAL)
    c, t = F.col("conv_id"), F.col("turn")
    a = a.withColumn("position", F.when((c % 5 == 0) & (t == 2), None).when((c % 11 == 4) & (t == 0), -1).otherwise(F.col("position")))
    return ordered_release(a.withColumn("page_no", F.when(~((c % 7 == 3) & (t == 1)), c)), tie=["turn"])


@query("stream_release", sql=f"""
WITH r AS (SELECT conv_id, turn, text, '{CONDITIONS_SITE}' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url,
                  role <> 'system' AS fetched FROM conversations),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM r WHERE fetched AND turn <> 3 AND text <> '')
SELECT 'item' AS kind, url AS source_url, place, md5(text) AS text_md5, CAST(NULL AS VARCHAR) AS reason FROM k
UNION ALL SELECT 'reject', url, NULL, NULL, CASE WHEN NOT fetched THEN 'status 404' WHEN turn = 3 THEN 'no dateModified' ELSE 'no text' END
FROM r WHERE NOT (fetched AND turn <> 3 AND text <> '')""")
def stream_release(spark, sf_dir):
    """Article responses that land in three files in any order, one
    micro-batch each; what waits behind an empty slot comes with a later
    batch, and every page ends in list order."""
    responses = _article_responses(spark, sf_dir)
    root = scratch_path(spark, "release")
    for k in range(3):
        responses.where(F.col("arrival") % 3 == k).coalesce(1).write.mode("append").json(f"{root}/in")
    stores = sr.ReleaseStores(root)
    sr.run(spark, f"{root}/in", responses.schema, stores)
    page = F.regexp_extract("source_url", r"/(\d+)/\d+$", 1)
    none = F.lit(None)
    items = spark.read.parquet(stores.items).select(
        F.lit("item").alias("kind"), "source_url", (F.row_number().over(Window.partitionBy(page).orderBy("seq")) - 1).cast("long").alias("place"),
        F.md5("html").alias("text_md5"), none.cast("string").alias("reason"))
    rejects = spark.read.parquet(stores.rejects).select(F.lit("reject").alias("kind"), F.col("url").alias("source_url"),
                                                        none.cast("long").alias("place"), none.cast("string").alias("text_md5"), "reason")
    return items.unionByName(rejects)


@dataclass
class _Broken(si.StreamStores):
    """Stores whose dictionary target cannot be written."""

    def target(self, name: str) -> str:
        if name == "dictionary":
            raise OSError("target lost")
        return super().target(name)


_HALF_SQL = "(SELECT max(event_id) // 2 FROM events)"


@query("stream_commits", sql=f"""
WITH f AS ({S.EVENTS_FEED_SQL}),
one AS ({ledger_accept_sql(f'SELECT * FROM ({S.EVENTS_FEED_SQL}) WHERE seq < {_HALF_SQL}')}),
all_rows AS ({ledger_accept_sql(S.EVENTS_FEED_SQL)})
SELECT 'broken' AS step, seq, 0 AS batch FROM one
UNION ALL SELECT 'replayed', seq, CASE WHEN seq < {_HALF_SQL} THEN 0 ELSE 1 END FROM all_rows""")
def stream_commits(spark, sf_dir):
    """The second of two batches breaks between two targets; readers still
    see the first one only. After the replay they see both, every row once."""
    feed = S.events_feed(spark, sf_dir).select("seq", "kind", "source_id", "source_url", "modified_at", F.lit("").alias("text"))
    half = F.floor(feed.agg(F.max("seq") / 2).scalar())
    parts = [feed.where(F.col("seq") < half), feed.where(F.col("seq") >= half)]
    root = scratch_path(spark, "commits")
    stores = si.StreamStores(root)
    si.process_batch(parts[0], 0, stores, trainer=False)
    try:
        si.process_batch(parts[1], 1, _Broken(root), trainer=False)
    except OSError:
        pass
    seen = lambda step: si.read_target(spark, stores, "accepted").select(F.lit(step).alias("step"), "seq", F.col("batch").cast("int").alias("batch"))
    broken = seen("broken")
    si.process_batch(parts[1], 1, stores, trainer=False)
    return broken.unionByName(seen("replayed"))


@query("registered_sources", sql=f"""
WITH c AS (SELECT conv_id, turn, role = 'system' AS lost, turn = 3 AS undated, text = '' AS bare FROM conversations)
SELECT 'conditions' AS source_id, 'document' AS outcome, CAST(NULL AS VARCHAR) AS reason, count(*) AS n FROM c WHERE NOT lost AND NOT undated AND NOT bare HAVING count(*) > 0
UNION ALL SELECT 'conditions', 'reject', CASE WHEN lost THEN 'status 404' WHEN undated THEN 'no dateModified' ELSE 'no text' END, count(*)
FROM c WHERE lost OR undated OR bare GROUP BY ALL
UNION ALL SELECT 'news', CASE WHEN n_chars > 3000 THEN 'reject' ELSE 'document' END, CASE WHEN n_chars > 3000 THEN 'no text block' END, count(*) FROM documents GROUP BY ALL
UNION ALL SELECT 'reviews', CASE WHEN status = 'ok' THEN 'document' ELSE 'reject' END, nullif(status, 'ok'), count(*) FROM ({REVIEW_STATUS_SQL}) GROUP BY ALL""")
def registered_sources(spark, sf_dir):
    """Three sources by their registered extractors through one ingest job."""
    inputs = {"conditions": {"articles": _article_responses(spark, sf_dir)},
              "news": {"articles": _news_pages(spark, sf_dir), "run_ts": F.lit(NEWS_TIME).cast("timestamp")},
              "reviews": {"pages": review_pages(spark, sf_dir)}}
    res, rejects = ex.run_sources(inputs, spark.createDataFrame([], si.ROUTES_SCHEMA), run_ts=F.lit(NEWS_TIME).cast("timestamp"), trainer=False)
    rows = res.documents.select("source_id", F.lit("document").alias("outcome"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("source_id", F.lit("reject").alias("outcome"), "reason"))
    return rows.groupBy("source_id", "outcome", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("ledger_large_batch", sql=f"""
SELECT source_id, url, modified_at, url IN (SELECT source_url FROM ({BATCH2_SQL})) AS touched FROM ({LEDGER1_SQL})""")
def ledger_large_batch(spark, sf_dir):
    """The stored ledger against a batch whose keys are too many to be
    broadcast (here: more than none); a Bloom filter of the keys keeps the
    other stored rows out of the exact join."""
    b1, b2 = S.split_batches(spark, sf_dir)
    stored = led.apply(None, led.decide(b1))
    urls = b2.select(F.col("source_url").alias("url")).distinct()
    touched = keyed_filter(stored, urls, "url", "left_semi", 0).withColumn("touched", F.lit(True))
    return touched.unionByName(keyed_filter(stored, urls, "url", "left_anti", 0).withColumn("touched", F.lit(False)))


# --- K3, K4: stores by key -------------------------------------------------------------------

_STORE_SQL = f"""
WITH d1 AS (SELECT 'order' AS item_type, CAST(o_orderkey AS VARCHAR) AS item_id, o_orderpriority AS name FROM orders WHERE o_orderstatus <> 'P'
            UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_size <= 25),
d AS (SELECT * FROM d1 WHERE NOT (item_type = 'part' AND item_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size % 10 = 0))
      UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), 'new ' || p_name FROM part WHERE p_size % 10 = 0),
e1 AS ({E1_SQL}),
t AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 4 = 0),
e AS (SELECT * FROM e1 WHERE src_item_id NOT IN (SELECT id FROM t)
      UNION ALL SELECT 'open', 'order', CAST(l_orderkey AS VARCHAR), 'part', CAST(l_partkey AS VARCHAR)
      FROM lineitem WHERE l_orderkey % 4 = 0 AND l_linestatus = 'O')
SELECT e.*, d2.name AS dst_name, d2.item_id IS NOT NULL AS resolved
FROM e LEFT JOIN d d2 ON d2.item_type = e.dst_item_type AND d2.item_id = e.dst_item_id
WHERE EXISTS (SELECT 1 FROM d WHERE d.item_type = e.src_item_type AND d.item_id = e.src_item_id)"""


def keyed_store(spark, sf_dir, root=None):
    """Two versions of a dictionary store over orders and parts; returns the store."""
    store = DictionaryStore(root or scratch_path(spark, "keyed"))
    items = _graph_dictionary(spark, sf_dir).select("item_type", "item_id", "name", F.lit("").alias("description"), F.lit(None).cast("string").alias("meta"),
                                                    F.lit(0).cast("long").alias("seq"))
    edges = _order_edges(spark, sf_dir)
    store.update(spark, 0, items, edges.select("src_item_type", "src_item_id"), edges)
    parts = S.table(spark, sf_dir, "part").where("p_size % 10 = 0").select(
        F.lit("part").alias("item_type"), F.col("p_partkey").cast("string").alias("item_id"), F.concat(F.lit("new "), "p_name").alias("name"),
        F.lit("").alias("description"), F.lit(None).cast("string").alias("meta"), F.lit(1).cast("long").alias("seq"))
    touched = S.table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(
        F.lit("order").alias("src_item_type"), F.col("o_orderkey").cast("string").alias("src_item_id"))
    fresh = S.table(spark, sf_dir, "lineitem").where("l_orderkey % 4 = 0 AND l_linestatus = 'O'").select(
        F.lit("open").alias("link_type"), F.lit("order").alias("src_item_type"), F.col("l_orderkey").cast("string").alias("src_item_id"),
        F.lit("part").alias("dst_item_type"), F.col("l_partkey").cast("string").alias("dst_item_id"))
    store.update(spark, 1, parts, touched, fresh)
    return store


@query("dictionary_store", sql=_STORE_SQL)
def dictionary_store(spark, sf_dir):
    """Dictionary and links as stored tables by key,
    updated by a second batch, read back as links with their targets."""
    return keyed_store(spark, sf_dir).resolved(spark, 1)
