"""Named queries: markup, ingest and the ledger family."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.dates import if_modified_since
from quire.functions.markup import strip_tags, strip_tags_sql
from quire.operators import ingest as ing
from quire.operators import ledger as led
from quire.operators import frontier as fr
from quire.plans import standins as S
from quire.plans.registry import query


# --- SQL helpers (oracle side) ---------------------------------------------

def ledger_accept_sql(feed: str, prior: str | None = None, policy: str = "different") -> str:
    """Accepted rows of ``feed`` against ``prior`` (single-window form)."""
    rows = f"SELECT seq, source_id, source_url, modified_at, FALSE AS is_prior FROM ({feed})"
    if prior:
        rows += (f" UNION ALL SELECT -1, source_id, url, modified_at, TRUE FROM ({prior}) "
                 f"WHERE url IN (SELECT source_url FROM ({feed}))")
    prev = "last_value(modified_at IGNORE NULLS)" if policy == "different" else "max(modified_at)"
    cond = "pm <> modified_at" if policy == "different" else "modified_at > pm"
    return f"""
SELECT seq, source_id, source_url, modified_at FROM (
  SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq) AS rn,
         first_value(modified_at) OVER (PARTITION BY source_url ORDER BY seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fm,
         {prev} OVER (PARTITION BY source_url ORDER BY seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
  FROM ({rows}))
WHERE NOT is_prior AND (rn = 1 OR (modified_at IS NOT NULL AND fm IS NOT NULL AND {cond}))"""


def ledger_state_sql(accepted: str, prior: str | None = None) -> str:
    last = f"""
SELECT source_id, source_url AS url, modified_at FROM (
  SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq DESC) AS rk FROM ({accepted}))
WHERE rk = 1"""
    if not prior:
        return last
    return (f"SELECT source_id, url, modified_at FROM ({prior}) WHERE url NOT IN "
            f"(SELECT url FROM ({last})) UNION ALL {last}")


BATCH1_SQL = f"SELECT * FROM ({S.EVENTS_FEED_SQL}) WHERE ts < (SELECT mid FROM ({S.MIDPOINT_SQL}))"
BATCH2_SQL = f"SELECT * FROM ({S.EVENTS_FEED_SQL}) WHERE ts >= (SELECT mid FROM ({S.MIDPOINT_SQL}))"
LEDGER1_SQL = ledger_state_sql(ledger_accept_sql(BATCH1_SQL))


def _ledger1(spark, sf_dir):
    """Ledger log after the first half (its delta for batch 0), as a
    production run leaves it; returns ``(log, second_half)``."""
    from quire.session import scratch_path
    from quire.sinks.ledger_log import LedgerLog

    b1, b2 = S.split_batches(spark, sf_dir)
    log = LedgerLog(scratch_path(spark, "ledger"))
    log.append_delta(led.apply(None, led.decide(b1)), 0)
    return log, b2


# --- markup ------------------------------------------------------------------

@query("html_to_text", sql=f"""
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (
  SELECT page_id, url, {strip_tags_sql('html')} AS text FROM pages)
WHERE text <> ''""")
def html_to_text(spark, sf_dir):
    """Page markup to plain text, empty results dropped."""
    p = S.table(spark, sf_dir, "pages")
    t = p.select("page_id", "url", strip_tags("html").alias("text"))
    return (t.where(F.col("text") != "")
            .withColumn("n_chars", F.length("text").cast("long")))


@query("ingest_pages", sql=f"""
WITH feed AS ({S.PAGES_FEED_SQL}),
acc AS ({ledger_accept_sql('SELECT * FROM feed')}),
routes AS ({S.routes_sql('feed')})
SELECT f.source_url, r.project_id, 'spidered' AS filename,
       {strip_tags_sql('f.html')} AS text,
       CAST(to_json({{'source_id': f.source_id, 'source_url': f.source_url}}) AS VARCHAR) AS meta
FROM feed f JOIN acc a ON a.seq = f.seq LEFT JOIN routes r ON r.source_id = f.source_id""")
def ingest_pages(spark, sf_dir):
    """C1 + J5: pages as html items through the ledger to document rows."""
    feed = S.pages_feed(spark, sf_dir)
    res = ing.ingest(feed, None, S.routes_for(feed), run_ts=F.lit(None).cast("timestamp"))
    return res.documents.select("source_url", "project_id", "filename", "text", "meta")


# --- ledger --------------------------------------------------------------------

@query("ledger_accept", sql=f"""
SELECT seq, source_id, source_url AS url, modified_at
FROM ({ledger_accept_sql(S.EVENTS_FEED_SQL)})""")
def ledger_accept(spark, sf_dir):
    """Accepted items of the events feed against an empty ledger."""
    acc = led.accept(S.events_feed(spark, sf_dir))
    return acc.select("seq", "source_id", F.col("source_url").alias("url"), "modified_at")


@query("ledger_state", sql=ledger_state_sql(ledger_accept_sql(S.EVENTS_FEED_SQL)))
def ledger_state(spark, sf_dir):
    """Ledger after the whole feed."""
    return led.apply(None, led.decide(S.events_feed(spark, sf_dir)))


@query("ledger_two_batches", sql=f"""
SELECT seq, source_id, source_url AS url, modified_at
FROM ({ledger_accept_sql(BATCH2_SQL, LEDGER1_SQL)})""")
def ledger_two_batches(spark, sf_dir):
    """U1 with prior state: second half of the feed against the first half's ledger."""
    log, b2 = _ledger1(spark, sf_dir)
    prior = log.rows_for(spark, b2.select(F.col("source_url").alias("url")), before=1)
    acc = led.accept(b2, prior)
    return acc.select("seq", "source_id", F.col("source_url").alias("url"), "modified_at")


@query("high_water_mark", sql=f"""
SELECT source_id, max(modified_at) AS high_water_mark,
       strftime(max(modified_at), '%Y-%m-%d') AS start_date
FROM ({ledger_state_sql(ledger_accept_sql(S.EVENTS_FEED_SQL))}) GROUP BY source_id""")
def high_water_mark(spark, sf_dir):
    """Per-source mark of the final ledger, cut to the day."""
    return led.high_water_mark(led.apply(None, led.decide(S.events_feed(spark, sf_dir))))


def _frontier(b2):
    """Requests of the second half: earliest per URL (U8), flags from the event."""
    reqs = b2.select(F.col("source_url").alias("url"), "seq",
                     (F.col("value") >= 90).alias("force_refresh"),
                     (F.col("source_id") == "view").alias("dont_refresh"))
    return fr.dedup_requests(reqs)


FRONTIER_SQL = f"""
SELECT url, force_refresh, dont_refresh FROM (
  SELECT source_url AS url, value >= 90 AS force_refresh, source_id = 'view' AS dont_refresh,
         row_number() OVER (PARTITION BY source_url ORDER BY seq) AS rk
  FROM ({BATCH2_SQL})) WHERE rk = 1"""


@query("refresh_plan", sql=f"""
WITH l AS ({LEDGER1_SQL}), f AS ({FRONTIER_SQL})
SELECT f.url, f.force_refresh, f.dont_refresh,
       CASE WHEN NOT f.force_refresh AND l.modified_at IS NOT NULL AND f.dont_refresh THEN 'skip'
            WHEN NOT f.force_refresh AND l.modified_at IS NOT NULL THEN 'conditional'
            ELSE 'fetch' END AS action,
       CASE WHEN NOT f.force_refresh AND l.modified_at IS NOT NULL AND NOT f.dont_refresh
            THEN strftime(l.modified_at, '%a, %d %b %Y %H:%M:%S') || ' +0000' END AS if_modified_since
FROM f LEFT JOIN l ON l.url = f.url""")
def refresh_plan(spark, sf_dir):
    """Fetch decision for the second half's requests."""
    log, b2 = _ledger1(spark, sf_dir)
    ledger1 = log.state(spark).withColumn("modified_at", F.col("modified_at").cast("timestamp"))
    plan = led.refresh_plan(_frontier(b2), ledger1)
    return plan.select("url", "force_refresh", "dont_refresh", "action", "if_modified_since")


@query("skip_known", sql=f"""
WITH l AS ({LEDGER1_SQL})
SELECT DISTINCT source_url AS url FROM ({S.EVENTS_FEED_SQL})
WHERE source_url NOT IN (SELECT url FROM l WHERE modified_at IS NOT NULL)""")
def skip_known(spark, sf_dir):
    """URLs of the whole feed not already held with a time."""
    log, _ = _ledger1(spark, sf_dir)
    ledger1 = log.state(spark)
    reqs = S.events_feed(spark, sf_dir).select(F.col("source_url").alias("url")).distinct()
    return led.skip_known(reqs, ledger1)


# --- responses -----------------------------------------------------------------

RESPONSES_SQL = f"""
SELECT seq, source_url AS url,
       CAST(CASE source_id WHEN 'click' THEN 200 WHEN 'view' THEN 304 WHEN 'signup' THEN 404
            WHEN 'purchase' THEN 429 WHEN 'error' THEN 503 END AS INTEGER) AS status,
       CASE WHEN source_id = 'purchase' THEN json_extract_string(props, '$.k')
            WHEN source_id = 'error' AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 50
            THEN 'Wed, 21 Oct 2015 07:28:00 GMT' END AS retry_after,
       ts AS received_at
FROM ({S.EVENTS_FEED_SQL})"""


def _responses(spark, sf_dir):
    e = S.events_feed(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    status = (F.when(F.col("source_id") == "click", 200).when(F.col("source_id") == "view", 304)
              .when(F.col("source_id") == "signup", 404).when(F.col("source_id") == "purchase", 429)
              .when(F.col("source_id") == "error", 503)).cast("int")
    retry = (F.when(F.col("source_id") == "purchase", k)
             .when((F.col("source_id") == "error") & (k.cast("int") < 50),
                   F.lit("Wed, 21 Oct 2015 07:28:00 GMT")))
    return e.select("seq", F.col("source_url").alias("url"), status.alias("status"),
                    retry.alias("retry_after"), F.col("ts").alias("received_at"))


@query("response_triage", sql=f"""
SELECT seq, url, status,
       CASE WHEN status IN (429, 503) THEN 'retry' WHEN status = 304 THEN 'drop' ELSE 'accept' END AS action,
       CASE WHEN status IN (429, 503) THEN coalesce(TRY_CAST(retry_after AS INTEGER), 30) END AS delay_s,
       CASE WHEN status IN (429, 503)
            THEN received_at + to_seconds(CAST(coalesce(TRY_CAST(retry_after AS INTEGER), 30) AS BIGINT)) END
            AS next_attempt_at
FROM ({RESPONSES_SQL})""")
def response_triage(spark, sf_dir):
    """Retry / drop / accept per response."""
    return fr.triage(_responses(spark, sf_dir)).select(
        "seq", "url", "status", "action", "delay_s", "next_attempt_at")


@query("raw_cacheable", sql=f"""
SELECT seq, url, status FROM ({RESPONSES_SQL})
WHERE status NOT IN (401, 403, 429, 500, 502, 503)""")
def raw_cacheable(spark, sf_dir):
    """Responses kept in the raw response store."""
    return fr.cacheable(_responses(spark, sf_dir)).select("seq", "url", "status")


# --- rejects -------------------------------------------------------------------

DOC_FEED_SQL = """
SELECT doc_id AS seq, 'text' AS kind,
       CASE WHEN doc_id % 29 = 0 THEN repeat(source, 8) ELSE source END AS source_id,
       CASE WHEN doc_id % 23 = 0 THEN NULL
            ELSE 'https://' || source || '.example.org/' || repeat('p', CAST(n_chars % 300 AS INTEGER))
                 || '/' || CAST(doc_id AS VARCHAR) END AS source_url,
       CAST(NULL AS TIMESTAMP) AS modified_at, text
FROM documents"""


def docs_feed(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("seq"), F.lit("text").alias("kind"),
        F.when(F.col("doc_id") % 29 == 0, F.repeat("source", 8)).otherwise(F.col("source")).alias("source_id"),
        F.when(F.col("doc_id") % 23 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("https://"), "source", F.lit(".example.org/"),
                             F.repeat(F.lit("p"), (F.col("n_chars") % 300).cast("int")),
                             F.lit("/"), F.col("doc_id").cast("string"))).alias("source_url"),
        F.lit(None).cast("timestamp_ntz").alias("modified_at"), "text")


@query("missing_and_long", sql=f"""
SELECT source_id, source_url AS url, 'classify' AS stage,
       CASE WHEN source_url IS NULL THEN 'missing source_url'
            WHEN length(source_url) > 255 THEN 'source_url too long'
            ELSE 'source_id too long' END AS reason
FROM ({DOC_FEED_SQL})
WHERE source_url IS NULL OR length(source_url) > 255 OR length(source_id) > 32""")
def missing_and_long(spark, sf_dir):
    """Reject rows with reasons."""
    _, rejects, _ = ing.classify(docs_feed(spark, sf_dir))
    return rejects


@query("corpus_versions", sql=f"""
SELECT seq, source_url AS url, modified_at,
       row_number() OVER (PARTITION BY source_url ORDER BY seq) AS version
FROM ({ledger_accept_sql(S.EVENTS_FEED_SQL)})""")
def corpus_versions(spark, sf_dir):
    """Version number of each accepted document per URL."""
    v = led.versions(led.decide(S.events_feed(spark, sf_dir)))
    return v.select("seq", F.col("source_url").alias("url"), "modified_at", "version")


REVERSED_SQL = f"SELECT * REPLACE (1000000000 - seq AS seq) FROM ({S.EVENTS_FEED_SQL})"


@query("late_data_policy", sql=f"""
SELECT 'different' AS policy, seq, source_url AS url, modified_at
FROM ({ledger_accept_sql(REVERSED_SQL, policy='different')})
UNION ALL
SELECT 'newer' AS policy, seq, source_url AS url, modified_at
FROM ({ledger_accept_sql(REVERSED_SQL, policy='newer')})""")
def late_data_policy(spark, sf_dir):
    """The feed in reverse arrival order under both policies."""
    feed = S.events_feed(spark, sf_dir).withColumn("seq", F.lit(1_000_000_000) - F.col("seq"))
    out = None
    for policy in ("different", "newer"):
        acc = led.accept(feed, None, policy=policy).select(
            F.lit(policy).alias("policy"), "seq", F.col("source_url").alias("url"), "modified_at")
        out = acc if out is None else out.unionByName(acc)
    return out


DOC_ITEMS_SQL = """
SELECT doc_id AS seq, source AS source_id, 'https://corpus.example.org/' || source || '/'
       || repeat('x', CAST(n_chars % 160 AS INTEGER)) || '/' || CAST(doc_id AS VARCHAR) AS source_url, text
FROM documents"""


@query("doc_meta_json", sql=f"""
WITH f AS ({DOC_ITEMS_SQL}), r AS ({S.routes_sql('f')})
SELECT f.source_url, r.project_id, r.dataset_id, 'spidered' AS filename,
       CAST(to_json({{'source_id': f.source_id, 'source_url': f.source_url}}) AS VARCHAR) AS meta,
       right(f.source_url, 150) AS name, CAST(length(f.text) AS BIGINT) AS n_chars, CAST(length(f.text) AS BIGINT) AS trainer_chars
FROM f LEFT JOIN r ON r.source_id = f.source_id
WHERE length(f.source_url) <= 255""")
def doc_meta_json(spark, sf_dir):
    """Documents as text items through ingest - stored rows
    with their JSON meta, and concept-trainer rows named by the last 150
    characters of the URL (URLs over 255 characters are rejected first)."""
    d = S.table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://corpus.example.org/"), "source", F.lit("/"),
                   F.repeat(F.lit("x"), (F.col("n_chars") % 160).cast("int")), F.lit("/"), F.col("doc_id").cast("string"))
    feed = d.select(F.col("doc_id").alias("seq"), F.lit("text").alias("kind"), F.col("source").alias("source_id"),
                    url.alias("source_url"), "text")
    res = ing.ingest(feed, None, S.routes_for(feed), run_ts=F.lit(None).cast("timestamp"))
    docs = res.documents.select("source_url", "project_id", "filename", "meta", F.length("text").cast("long").alias("n_chars"))
    trainer = res.trainer.select(F.col("name"), "dataset_id", F.length("text").cast("long").alias("trainer_chars"))
    # one trainer row per stored document, paired on the URL tail (unique here);
    # a full join, so that a lost row on either side shows
    return (docs.withColumn("name", F.right("source_url", F.lit(150))).join(trainer, "name", "full_outer")
            .select("source_url", "project_id", "dataset_id", "filename", "meta", "name", "n_chars", "trainer_chars"))


HALF_SQL = "(SELECT (min(event_id) + max(event_id)) // 2 FROM events)"


@query("corpus_as_of", sql=f"""
WITH a AS ({ledger_accept_sql(S.EVENTS_FEED_SQL)})
SELECT source_url, seq, source_id, modified_at FROM (
  SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq DESC) AS rk FROM a WHERE seq <= {HALF_SQL}) WHERE rk = 1""")
def corpus_as_of(spark, sf_dir):
    """The corpus as it stood half-way through the feed's arrivals."""
    feed = S.events_feed(spark, sf_dir)
    half = S.table(spark, sf_dir, "events").agg(F.expr("(min(event_id) + max(event_id)) div 2")).scalar()
    return led.as_of(led.decide(feed), half).select("source_url", "seq", "source_id", "modified_at")


@query("incremental_start", sql=f"""
WITH a AS ({ledger_accept_sql(BATCH1_SQL)}),
m AS (SELECT source_id, date_trunc('day', max(modified_at)) AS d FROM ({ledger_state_sql('SELECT * FROM a')}) GROUP BY source_id)
SELECT f.seq, f.source_id, f.source_url, f.modified_at
FROM ({S.EVENTS_FEED_SQL}) f LEFT JOIN m USING (source_id) WHERE d IS NULL OR f.modified_at >= d""")
def incremental_start(spark, sf_dir):
    """An incremental run starts at each source's high-water
    mark, cut to its day; the marks come from the stored ledger."""
    log, _ = _ledger1(spark, sf_dir)
    marks = led.high_water_mark(log.state(spark))
    return led.since_mark(S.events_feed(spark, sf_dir), marks).select("seq", "source_id", "source_url", "modified_at")


@query("project_store", sql=f"""
WITH r AS ({S.routes_sql('(SELECT source AS source_id FROM documents)')}), p AS (SELECT min(project_id) AS project_id FROM r)
SELECT project_id, 'https://corpus.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) AS source_url, text
FROM documents JOIN r ON r.source_id = source WHERE project_id = (SELECT project_id FROM p)""")
def project_store(spark, sf_dir):
    """Documents ingested in two appends to a store partitioned by
    project; the documents of one project come from its partition alone."""
    from quire.sinks.tables import append_documents
    from quire.session import scratch_path
    from quire.sources.extractors import project_documents

    d = S.table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://corpus.example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    feed = d.select(F.col("doc_id").alias("seq"), F.lit("text").alias("kind"), F.col("source").alias("source_id"),
                    url.alias("source_url"), "text")
    routes, path = S.routes_for(feed), scratch_path(spark, "documents")
    for part in (feed.where("length(text) < 1000"), feed.where("length(text) >= 1000")):
        append_documents(ing.ingest(part, None, routes, run_ts=F.lit(None).cast("timestamp"), trainer=False).documents, path)
    first = routes.agg(F.min("project_id")).head()[0]
    return project_documents(spark, path, first).select(F.col("project_id").cast("long").alias("project_id"), "source_url", "text")
