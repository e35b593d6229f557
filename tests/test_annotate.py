"""C2 pre-annotation (fixture F10): skip annotated docs, get-or-create labels, counters."""

from quire.operators import annotate as an


def test_pre_annotate(spark):
    docs = spark.createDataFrame([
        (1, "nothing here"), (2, "testing once"), (3, "testing, a testing. testing!"),
        (4, "testing already done"), (5, "xtesting testingx étesting testing😀"),
    ], "doc_id long, text string")
    ann = spark.createDataFrame([(4, 0, 7)], "doc_id long, start_offset long, end_offset long")
    labels = spark.createDataFrame([(5, "other")], "id long, text string")
    run = an.pre_annotate(docs, ann, labels, pattern=r"\b(testing)\b")
    rows = sorted((r.doc_id, r.start_offset, r.end_offset, r.label, r.prob) for r in run.annotations.collect())
    assert rows == [(2, 0, 7, 6, 0.8), (3, 0, 7, 6, 0.8), (3, 11, 18, 6, 0.8), (3, 20, 27, 6, 0.8),
                    (5, 27, 34, 6, 0.8)]
    assert [(r.text, r.id) for r in run.labels.collect()] == [("testing", 6)]
    c = run.counters.first()
    assert (c.docs_scanned, c.docs_annotated, c.spans, c.labels_added) == (5, 4, 5, 1)


def test_existing_label_reused(spark):
    docs = spark.createDataFrame([(1, "testing")], "doc_id long, text string")
    ann = spark.createDataFrame([], "doc_id long")
    labels = spark.createDataFrame([(3, "testing")], "id long, text string")
    run = an.pre_annotate(docs, ann, labels, pattern=r"\b(testing)\b")
    assert [r.label for r in run.annotations.collect()] == [3]
    assert run.labels.count() == 0
