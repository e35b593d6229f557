"""Pre-annotation (C2): unannotated documents -> spans -> label ids -> rows
(P15, F20, X3, U5, J4, A2, K7, K8), levels and agreement (R3, R5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quire.functions.spans import DEFAULT_PATTERN, DEFAULT_PROB, python_spans, rule_spans
from quire.operators.ids import get_or_create
from quire.session import bounded_broadcast, scratch_path

MAX_BROADCAST_LABELS = 1_000_000


def spans(docs: DataFrame, text_col: str = "text", *, pattern: str = DEFAULT_PATTERN,
          prob: float = DEFAULT_PROB, annotator=None, skip_one: bool = False) -> DataFrame:
    """Add ``spans`` from a rule (native) or a Python annotator plug-in."""
    if annotator is None and not skip_one:
        col: Column = rule_spans(text_col, pattern, prob)
    else:
        col = python_spans(annotator, pattern=pattern, prob=prob, skip_one=skip_one)(F.col(text_col))
    return docs.withColumn("spans", col)


def explode_spans(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per span."""
    return (docs.select(*keys, F.explode("spans").alias("s"))
            .select(*keys, "s.start_offset", "s.end_offset", "s.label", "s.prob"))


def unannotated(docs: DataFrame, annotations: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with no annotation row."""
    return docs.join(annotations.select(key).distinct(), key, "left_anti")


@dataclass
class AnnotationRun:
    annotations: DataFrame   # K7 rows with label ids
    labels: DataFrame        # K8 created labels (id, text)
    counters: DataFrame      # A2 one row
    spans: DataFrame         # exploded spans with label text


def pre_annotate(docs: DataFrame, annotations: DataFrame, labels: DataFrame, *,
                 key: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, **annotator) -> AnnotationRun:
    """C2 as one job: annotate only unannotated documents, create missing
    labels (one per distinct unseen text), attach label ids, count.

    The texts are matched once: the spans of every document are written to the
    shared checkpoint folder with the columns named in ``carry``, and the
    documents and spans of that pass are counted while it writes (an
    observation in its last stage, so a task that is run again counts once)."""
    keys = [key, *(carry or [])]
    path, pass_ = scratch_path(docs.sparkSession, "spans"), Observation("annotated")
    found = spans(unannotated(docs, annotations, key), text_col, **annotator).select(*keys, "spans")
    (found.observe(pass_, F.count(F.lit(1)).alias("docs"), F.sum(F.greatest(F.size("spans"), F.lit(0))).alias("spans"))
     .write.parquet(path))
    rows = explode_spans(docs.sparkSession.read.schema(found.schema).parquet(path), keys)
    matched = rows.select(F.col("label").alias("text"))
    all_labels, created = get_or_create(labels.select("id", "text"), matched, "text")
    lab, _ = bounded_broadcast(all_labels.select(F.col("text").alias("label"), F.col("id").alias("label_id")),
                               MAX_BROADCAST_LABELS)
    ann = rows.join(lab, "label").select(*keys, "start_offset", "end_offset",
                                         F.col("label_id").alias("label"), "prob")
    seen = pass_.get
    counters = docs.agg(F.count(F.lit(1)).alias("docs_scanned")).select(
        "docs_scanned", F.lit(seen.get("docs") or 0).cast("long").alias("docs_annotated"),
        F.lit(seen.get("spans") or 0).cast("long").alias("spans"),
        created.agg(F.count(F.lit(1))).scalar().cast("long").alias("labels_added"))
    return AnnotationRun(ann, created, counters, rows)


# Offsets are cut into cells of this many characters to join overlapping spans.
CELL = 64


def overlapping(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """The spans of ``a`` with ``overlaps``, whether a span of ``b`` in the
    same document shares a character with it. Spans meet in the offset cells
    they cover, so a text with many spans is never paired span by span."""
    def cells(df, start, end):
        return df.withColumn("_cell", F.explode(F.sequence(F.expr(f"{start} div {CELL}"), F.expr(f"greatest({end} - 1, {start}) div {CELL}"))))

    k = [key, "start_offset", "end_offset"]
    left = cells(a.select(*k).distinct(), "start_offset", "end_offset")
    right = cells(b.select(F.col(key), F.col("start_offset").alias("_s"), F.col("end_offset").alias("_e")).distinct(), "_s", "_e")
    hit = left.join(right, [key, "_cell"]).where("_s < end_offset AND start_offset < _e").select(*k).distinct()
    return a.join(hit.withColumn("overlaps", F.lit(True)), k, "left").withColumn("overlaps", F.coalesce("overlaps", F.lit(False)))


# --- levels and agreement ---------------------------------------------------------

def levels(docs: DataFrame, sentence: str, term: str, *, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Intervals of every document, sentence and term, with offsets.

    (key, level, unit_no, start_offset, end_offset, label, sent_no): a term
    names the sentence that holds it whole (null if none does). Sentences and
    terms are merged by their starts within each document; the text is not
    read again for a sentence."""
    none = F.lit(None)
    sent = (docs.select(key, F.posexplode(rule_spans(text_col, sentence)).alias("unit_no", "s"))
            .select(key, F.lit("sentence").alias("level"), F.col("unit_no").cast("long").alias("unit_no"), "s.start_offset", "s.end_offset",
                    none.cast("string").alias("label")))
    terms = (docs.select(key, F.posexplode(rule_spans(text_col, term)).alias("unit_no", "s"))
             .select(key, F.lit("term").alias("level"), F.col("unit_no").cast("long").alias("unit_no"), "s.start_offset", "s.end_offset", "s.label"))
    w = Window.partitionBy(key).orderBy("start_offset", "level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_sent = F.col("level") == "sentence"
    merged = sent.unionByName(terms).withColumn("_in", F.last(F.when(is_sent, F.struct("unit_no", "end_offset")), ignorenulls=True).over(w))
    held = merged.withColumn("sent_no", F.when(F.col("end_offset") <= F.col("_in.end_offset"), F.col("_in.unit_no"))).drop("_in")
    whole = docs.where(F.col(text_col).isNotNull()).select(
        key, F.lit("document").alias("level"), F.lit(0).cast("long").alias("unit_no"), F.lit(0).cast("long").alias("start_offset"),
        F.length(text_col).cast("long").alias("end_offset"), none.cast("string").alias("label"), none.cast("long").alias("sent_no"))
    return whole.unionByName(held)


def agreement(a: DataFrame, b: DataFrame, docs: DataFrame, *, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How far two annotators agree, per label, in characters of the texts:
    ``n_both``, ``n_a_only``, ``n_b_only``, ``n_neither`` and Cohen's kappa
    (null where chance alone would agree everywhere).

    Both annotators' span boundaries are swept in offset order per text and
    label; equal boundaries are added up before they are sorted."""
    def edges(df, da, db):
        at = F.explode(F.array(F.struct(F.col("start_offset").alias("at"), F.lit(1).alias("d")),
                               F.struct(F.col("end_offset").alias("at"), F.lit(-1).alias("d")))).alias("e")
        return df.select(key, "label", at).select(key, "label", "e.at", (F.col("e.d") * da).alias("da"), (F.col("e.d") * db).alias("db"))

    steps = edges(a, 1, 0).unionByName(edges(b, 0, 1)).groupBy(key, "label", "at").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = Window.partitionBy(key, "label").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = steps.select("label", (F.sum("da").over(upto) > 0).alias("a"), (F.sum("db").over(upto) > 0).alias("b"),
                        (F.lead("at").over(w) - F.col("at")).alias("n"))
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    per = runs.groupBy("label").agg(part(F.expr("a AND b")).alias("n_both"), part(F.expr("a AND NOT b")).alias("n_a_only"),
                                    part(F.expr("b AND NOT a")).alias("n_b_only"))
    total = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("long")).scalar()
    per = per.withColumn("_n", total).withColumn("n_neither", F.expr("_n - n_both - n_a_only - n_b_only"))
    pa, pb = F.expr("(n_both + n_a_only) / _n"), F.expr("(n_both + n_b_only) / _n")
    same, chance = F.expr("(n_both + n_neither) / _n"), pa * pb + (1 - pa) * (1 - pb)
    return per.withColumn("kappa", F.when(chance < 1, (same - chance) / (1 - chance))).drop("_n")
