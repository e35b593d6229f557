"""Named queries: rule annotation, labels, counters, exports and corpus SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.spans import rule_spans_sql
from quire.operators import annotate as an
from quire.operators import ingest as ing
from quire.operators.ids import get_or_create, sequential_ids
from quire.plans import standins as S
from quire.plans.registry import query
from quire.session import bounded_broadcast, scratch_path

# Patterns passed to the rule annotator (the shipped word does not occur in
# the driver's documents; these do).
TERM = r"\b(thing)\b"
TERMS = r"\b(thing|this|that|with)\b"
WIDE = r"\b(\w*thing\w*)\b"


def _spans_rows_sql(src: str, key: str, pattern: str) -> str:
    return f"""
SELECT {key}, s['start_offset'] AS start_offset, s['end_offset'] AS end_offset,
       s['label'] AS label, s['prob'] AS prob
FROM (SELECT {key}, unnest({rule_spans_sql('text', pattern)}) AS s FROM ({src}))"""


@query("annotate_terms", sql=_spans_rows_sql("SELECT * FROM documents", "doc_id", TERM))
def annotate_terms(spark, sf_dir):
    """Rule annotator over every document (native spans)."""
    d = S.table(spark, sf_dir, "documents")
    return an.explode_spans(an.spans(d, pattern=TERM), ["doc_id"])


UNLABELLED_SQL = "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


@query("annotate_unlabelled", sql=_spans_rows_sql(UNLABELLED_SQL, "doc_id", TERMS))
def annotate_unlabelled(spark, sf_dir):
    """Only documents without existing annotations are annotated."""
    d = S.table(spark, sf_dir, "documents")
    todo = an.unannotated(d, S.table(spark, sf_dir, "labels"))
    return an.explode_spans(an.spans(todo, pattern=TERMS), ["doc_id"])


def _existing_labels(spark, sf_dir):
    """Labels of an earlier run: what the same annotator finds in ``benchmark``."""
    b = S.table(spark, sf_dir, "benchmark")
    found = an.explode_spans(an.spans(b, pattern=TERMS), ["item_id"]).select(F.col("label").alias("text"))
    return sequential_ids(found.distinct(), ["text"], start=1)


EXISTING_LABELS_SQL = f"""
SELECT text, row_number() OVER (ORDER BY text) AS id FROM (
  SELECT DISTINCT label AS text FROM ({_spans_rows_sql('SELECT * FROM benchmark', 'item_id', TERMS)}))"""


@query("new_labels", sql=f"""
WITH ex AS ({EXISTING_LABELS_SQL}),
req AS (SELECT DISTINCT label AS text FROM ({_spans_rows_sql(UNLABELLED_SQL, 'doc_id', TERMS)})),
new AS (SELECT text, (SELECT coalesce(max(id), 0) FROM ex) + row_number() OVER (ORDER BY text) AS id
        FROM req WHERE text NOT IN (SELECT text FROM ex))
SELECT req.text, ex.id, FALSE AS created FROM req JOIN ex USING (text)
UNION ALL SELECT text, id, TRUE FROM new""")
def new_labels(spark, sf_dir):
    """Label ids for matched terms; unseen texts get new ids."""
    d = S.table(spark, sf_dir, "documents")
    todo = an.unannotated(d, S.table(spark, sf_dir, "labels"))
    matched = an.explode_spans(an.spans(todo, pattern=TERMS), ["doc_id"]).select(F.col("label").alias("text"))
    ids, _ = get_or_create(_existing_labels(spark, sf_dir), matched, "text")
    return ids.select("text", "id", "created")


@query("annotation_counters", sql=f"""
WITH ex AS ({EXISTING_LABELS_SQL}),
sp AS ({_spans_rows_sql(UNLABELLED_SQL, 'doc_id', TERMS)})
SELECT (SELECT count(*) FROM documents) AS docs_scanned,
       (SELECT count(*) FROM ({UNLABELLED_SQL})) AS docs_annotated,
       (SELECT count(*) FROM sp) AS spans,
       (SELECT count(DISTINCT label) FROM sp WHERE label NOT IN (SELECT text FROM ex)) AS labels_added""")
def annotation_counters(spark, sf_dir):
    """A2: documents scanned, annotated (even with zero matches), spans, labels added."""
    d = S.table(spark, sf_dir, "documents")
    run = an.pre_annotate(d, S.table(spark, sf_dir, "labels"), _existing_labels(spark, sf_dir),
                          pattern=TERMS)
    return run.counters


@query("annotator_agreement", sql=f"""
WITH a AS ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', TERM)}),
b AS ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', WIDE)})
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, count(a.doc_id) AS n_a, count(b.doc_id) AS n_b,
       count(CASE WHEN a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL THEN 1 END) AS n_both
FROM a FULL OUTER JOIN b ON a.doc_id = b.doc_id AND a.start_offset = b.start_offset
                         AND a.end_offset = b.end_offset
GROUP BY ALL""")
def annotator_agreement(spark, sf_dir):
    """Two annotators' spans matched exactly per document (equi join on
    document and offsets - no pairs are enumerated)."""
    d = S.table(spark, sf_dir, "documents")
    k = ["doc_id", "start_offset", "end_offset"]
    a = an.explode_spans(an.spans(d, pattern=TERM), ["doc_id"]).select(*k, F.lit(1).alias("in_a"))
    b = an.explode_spans(an.spans(d, pattern=WIDE), ["doc_id"]).select(*k, F.lit(1).alias("in_b"))
    j = a.join(b, k, "full_outer")
    return j.groupBy("doc_id").agg(
        F.count("in_a").alias("n_a"), F.count("in_b").alias("n_b"),
        F.count(F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), 1)).alias("n_both"))


SENTENCE = r"[^.!?]+[.!?]*"


@query("sentence_terms", sql=f"""
SELECT doc_id, sent_no, 'sentence' AS level, CAST(length(sentence) AS BIGINT) AS n_chars,
       CAST(len(regexp_extract_all(sentence, '{TERMS}', 1)) AS BIGINT) AS n_terms
FROM (SELECT doc_id, unnest(range(len(ss))) AS sent_no, unnest(ss) AS sentence
      FROM (SELECT doc_id, regexp_extract_all(text, '{SENTENCE}', 0) AS ss FROM documents))
WHERE len(regexp_extract_all(sentence, '{TERMS}', 1)) > 0""")
def sentence_terms(spark, sf_dir):
    """Sentence-level annotation counts (sentences by regex, terms by rule)."""
    d = S.table(spark, sf_dir, "documents")
    s = d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(SENTENCE), 0)).alias("sent_no", "sentence"))
    n = F.size(F.regexp_extract_all("sentence", F.lit(TERMS), 1)).cast("long")
    return (s.select("doc_id", F.col("sent_no").cast("long").alias("sent_no"), F.lit("sentence").alias("level"),
                     F.length("sentence").cast("long").alias("n_chars"), n.alias("n_terms"))
            .where(F.col("n_terms") > 0))


TOKEN_SPLIT = r"[^\p{L}]+"
MAX_LEXICON = 5_000_000


@query("lexicon_codes", sql=f"""
WITH lex AS (
  SELECT term, 'B' || CAST(min(item_id) AS VARCHAR) AS code FROM (
    SELECT item_id, unnest(regexp_split_to_array(lower(text), '{TOKEN_SPLIT}')) AS term FROM benchmark)
  WHERE term <> '' GROUP BY term),
tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{TOKEN_SPLIT}')) AS term FROM documents)
SELECT doc_id, code, term, count(*) AS n FROM tok JOIN lex USING (term) GROUP BY ALL""")
def lexicon_codes(spark, sf_dir):
    """Every word of every document coded from a code list (the lexicon
    is all words of ``benchmark``, letters of any script; broadcast only when
    its size has been checked)."""
    b = S.table(spark, sf_dir, "benchmark")
    lex = (b.select("item_id", F.explode(F.split(F.lower("text"), TOKEN_SPLIT, -1)).alias("term")).where("term <> ''")
           .groupBy("term").agg(F.concat(F.lit("B"), F.min("item_id").cast("string")).alias("code")))
    lex, _ = bounded_broadcast(lex, MAX_LEXICON)
    d = S.table(spark, sf_dir, "documents")
    tok = d.select("doc_id", F.explode(F.split(F.lower("text"), TOKEN_SPLIT, -1)).alias("term"))
    return tok.join(lex, "term").groupBy("doc_id", "code", "term").agg(F.count(F.lit(1)).alias("n"))


@query("export_jsonl", sql=f"""
SELECT doc_id, CAST(len(spans) AS BIGINT) AS n_spans,
       CAST(to_json({{'doc_id': doc_id, 'name': 'doc-' || CAST(doc_id AS VARCHAR), 'text': text, 'spans': spans}})
            AS VARCHAR) AS line
FROM (SELECT doc_id, text, {rule_spans_sql('text', TERMS)} AS spans FROM documents)""")
def export_jsonl(spark, sf_dir):
    """R2: one JSON line per document with its text and its spans (the
    spans are already an array on the row - nothing is regrouped)."""
    d = an.spans(S.table(spark, sf_dir, "documents"), pattern=TERMS)
    line = F.to_json(F.struct("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
                              "text", "spans"))
    return d.select("doc_id", F.size("spans").cast("long").alias("n_spans"), line.alias("line"))


@query("annotator_overlap", sql=f"""
WITH a AS ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', TERMS)}),
b AS ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', WIDE)})
SELECT doc_id, start_offset, end_offset, label, EXISTS (
  SELECT 1 FROM b WHERE b.doc_id = a.doc_id AND b.start_offset < a.end_offset AND a.start_offset < b.end_offset) AS overlaps
FROM a""")
def annotator_overlap(spark, sf_dir):
    """Which spans of one annotator another one's spans overlap."""
    d = S.table(spark, sf_dir, "documents")
    a = an.explode_spans(an.spans(d, pattern=TERMS), ["doc_id"])
    b = an.explode_spans(an.spans(d, pattern=WIDE), ["doc_id"])
    return an.overlapping(a, b).select("doc_id", "start_offset", "end_offset", "label", "overlaps")


@query("label_breakdown", sql=f"""
WITH r AS ({S.routes_sql('(SELECT source AS source_id FROM documents)')}),
sp AS ({_spans_rows_sql('SELECT * FROM documents', 'doc_id', TERMS)})
SELECT r.project_id, d.source, sp.label, count(DISTINCT doc_id) AS n_docs, count(*) AS n_spans
FROM sp JOIN documents d USING (doc_id) JOIN r ON r.source_id = d.source GROUP BY ALL""")
def label_breakdown(spark, sf_dir):
    """Spans counted by project, source and label; counted per document
    before anything is joined."""
    d = S.table(spark, sf_dir, "documents").withColumnRenamed("source", "source_id")
    per = (an.explode_spans(an.spans(d, pattern=TERMS), ["doc_id", "source_id"])
           .groupBy("doc_id", "source_id", "label").agg(F.count(F.lit(1)).alias("n")))
    per = per.groupBy("source_id", "label").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_spans"))
    return (per.join(S.routes_for(d), "source_id")
            .select("project_id", F.col("source_id").alias("source"), "label", "n_docs", "n_spans"))


@query("annotation_store", sql=f"""
WITH r AS ({S.routes_sql('(SELECT source AS source_id FROM documents)')}),
sp AS ({_spans_rows_sql(UNLABELLED_SQL, 'doc_id', TERMS)}),
ex AS ({EXISTING_LABELS_SQL}),
new AS (SELECT text, (SELECT coalesce(max(id), 0) FROM ex) + row_number() OVER (ORDER BY text) AS id
        FROM (SELECT DISTINCT label AS text FROM sp) WHERE text NOT IN (SELECT text FROM ex)),
lab AS (SELECT text, id FROM ex UNION ALL SELECT text, id FROM new)
SELECT r.project_id, sp.doc_id, sp.start_offset, sp.end_offset, lab.id AS label_id, lab.text AS label
FROM sp JOIN documents d USING (doc_id) JOIN r ON r.source_id = d.source JOIN lab ON lab.text = sp.label""")
def annotation_store(spark, sf_dir):
    """Annotation rows with their label ids written partitioned by
    project, created labels appended to the label store, both read back."""
    d = S.table(spark, sf_dir, "documents").withColumnRenamed("source", "source_id")
    old = _existing_labels(spark, sf_dir)
    run = an.pre_annotate(d, S.table(spark, sf_dir, "labels"), old, carry=["source_id"], pattern=TERMS)
    r, _ = bounded_broadcast(S.routes_for(d).select("source_id", "project_id"), ing.MAX_BROADCAST_ROUTES)
    rows = run.annotations.join(r, "source_id")
    path, labels = scratch_path(spark, "annotations"), scratch_path(spark, "labels")
    (rows.select("project_id", "doc_id", "start_offset", "end_offset", "label", "prob")
     .write.mode("overwrite").partitionBy("project_id").parquet(path))
    old.select("id", "text").write.parquet(labels)
    run.labels.select("id", "text").write.mode("append").parquet(labels)
    lab, _ = bounded_broadcast(spark.read.parquet(labels).select(F.col("id").alias("label_id"), F.col("text").alias("_text")),
                               an.MAX_BROADCAST_LABELS)
    return (spark.read.parquet(path).join(lab, F.col("label") == F.col("label_id"))
            .select(F.col("project_id").cast("long").alias("project_id"), "doc_id", "start_offset", "end_offset", "label_id",
                    F.col("_text").alias("label")))


@query("source_overview", sql=f"""
SELECT d.source, count(*) AS n_docs, count(l.doc_id) AS n_labelled,
       CAST(coalesce(sum(l.quality), 0) AS BIGINT) AS n_quality,
       CAST(coalesce(sum(l.toxic), 0) AS BIGINT) AS n_toxic,
       CAST(sum(len(regexp_extract_all(d.text, '{TERM}', 1))) AS BIGINT) AS n_terms
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""")
def source_overview(spark, sf_dir):
    """Corpus stores registered as views, one SQL question."""
    from quire.operators.catalog import register
    register(spark, {"corpus_documents": S.table(spark, sf_dir, "documents"),
                     "corpus_labels": S.table(spark, sf_dir, "labels")})
    return spark.sql(f"""
        SELECT d.source, count(*) AS n_docs, count(l.doc_id) AS n_labelled,
               CAST(coalesce(sum(l.quality), 0) AS BIGINT) AS n_quality,
               CAST(coalesce(sum(l.toxic), 0) AS BIGINT) AS n_toxic,
               CAST(sum(size(regexp_extract_all(d.text, '{TERM.replace(chr(92), chr(92) * 2)}', 1))) AS BIGINT) AS n_terms
        FROM corpus_documents d LEFT JOIN corpus_labels l ON l.doc_id = d.doc_id
        GROUP BY d.source""")
