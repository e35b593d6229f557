"""C1 ingest (fixture F1): classify, rejects, ledger, text, routing, stores."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import ingest as ing

T1 = dt.datetime(2024, 1, 1)


def _item(seq, kind, src, url, m=None, text=None, html=None, **kw):
    base = {f.name: None for f in schemas.ITEMS.fields}
    base.update(seq=seq, kind=kind, source_id=src, source_url=url, modified_at=m, text=text, html=html, **kw)
    return base


def test_ingest_routes_and_rejects(spark):
    long_ok = "http://x.org/" + "a" * (255 - 13)
    long_bad = long_ok + "b"
    rows = [
        _item(1, "html", "news", "http://n.org/1", T1, html="<p>Hi &amp; bye</p>"),
        _item(2, "text", "news", "http://n.org/2", text=""),
        _item(3, "text", "news", None, text="no url"),
        _item(4, "weird", "news", "http://n.org/4"),
        _item(5, "text", "news", long_ok, text="ok"),
        _item(6, "text", "news", long_bad, text="too long"),
        _item(7, "text", "s" * 33, "http://n.org/7", text="bad source"),
        _item(8, "html", "news", "http://n.org/1", T1, html="<p>same time</p>"),
        _item(9, "dictionary", "dict", "http://d.org/e1", item_type="element", item_id="e1", name="E",
              description="<p>d</p>", links=[{"link_type": None, "item_type": "attribute", "item_id": "a1"}]),
        _item(10, "text", "news", "http://n.org/10", text=None),
    ]
    items = spark.createDataFrame(rows, schemas.ITEMS)
    routes = spark.createDataFrame([("news", 11, 21)], schemas.ROUTES)
    res = ing.ingest(items, None, routes, run_ts=F.lit(T1).cast("timestamp"))
    docs = {r.source_url: r for r in res.documents.collect()}
    assert set(docs) == {"http://n.org/1", "http://n.org/2", long_ok, "http://n.org/10"}
    d1 = docs["http://n.org/1"]
    assert d1.text == "Hi & bye" and d1.project_id == 11 and d1.filename == "spidered" and d1.created_at == T1
    assert json.loads(d1.meta) == {"source_id": "news", "source_url": "http://n.org/1"}
    rej = sorted(((r.url or ""), r.stage, r.reason) for r in res.rejects.collect())
    assert rej == [("", "classify", "missing source_url"), ("http://n.org/1", "ledger", "unchanged"),
                   ("http://n.org/7", "classify", "source_id too long"), (long_bad, "classify", "source_url too long")]
    assert [r.seq for r in res.passthrough.collect()] == [4]
    assert [(r.item_type, r.item_id, r.name) for r in res.dictionary.collect()] == [("element", "e1", "E")]
    assert [(r.dst_item_type, r.dst_item_id) for r in res.links.collect()] == [("attribute", "a1")]
    assert sorted(r.url for r in res.ledger.collect()) == sorted(
        ["http://n.org/1", "http://n.org/2", long_ok, "http://n.org/10", "http://d.org/e1"])
    assert res.ledger_delta.count() == 5
    trainer = {r.name: r.dataset_id for r in res.trainer.collect()}
    assert trainer[long_ok[-150:]] == 21


def test_batches_through_the_ledger_log_equal_one_batch(spark):
    from quire.session import scratch_path
    from quire.sinks.ledger_log import LedgerLog

    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    rows = [_item(i, "text", "news", f"http://n.org/{(i * 5) % 7}", times[(i * 3) % 3 if i % 4 else 0], text=f"t{i}")
            for i in range(60)]
    feed = spark.createDataFrame(rows, schemas.ITEMS)
    routes = spark.createDataFrame([("news", 1, 2)], schemas.ROUTES)
    log = LedgerLog(scratch_path(spark, "usage-log"))
    got = []
    for b in range(3):
        items = feed.where(f"seq >= {b * 20} AND seq < {(b + 1) * 20}")
        prior = log.rows_for(spark, items.select(F.col("source_url").alias("url")), before=b)
        res = ing.ingest(items, prior, routes)
        got += [r.text for r in res.documents.collect()]
        log.append_delta(res.ledger_delta, b)
    whole = ing.ingest(feed, None, routes)
    assert sorted(got) == sorted(r.text for r in whole.documents.collect())
    assert {tuple(r) for r in log.state(spark).collect()} == \
           {tuple(r) for r in whole.ledger.select("source_id", "url", "modified_at").collect()}


def test_nothing_vanishes(spark):
    """Documents, rejects and passthrough add up to the input, whatever is null."""
    rows = [(None, "text", "s", "u/1", "t", None), (None, "text", "s", "u/1", "t", None), (3, "html", None, "u/2", None, "<p>x</p>"),
            (4, "text", "s", None, "t", None), (None, "text", "s", None, None, None), (6, None, "s", "u/3", "t", None),
            (7, "other", "s", "u/4", "t", None), (8, "text", "s", "u" * 300, "t", None), (9, "text", None, "u/5", None, None)]
    items = spark.createDataFrame([(*r, None) for r in rows],
                                  "seq long, kind string, source_id string, source_url string, text string, html string, modified_at timestamp")
    routes = spark.createDataFrame([("s", 1, 2)], "source_id string, project_id long, dataset_id long")
    for feed in (items, items.drop("seq")):
        res = ing.ingest(feed, None, routes, trainer=False)
        assert res.documents.count() + res.rejects.count() + res.passthrough.count() == len(rows)
        assert res.passthrough.count() == 2 and res.documents.count() == 3 and res.trainer is None
        assert {r.reason for r in res.rejects.collect()} == {"missing source_url", "source_url too long", "unchanged"}


def test_decide_returns_every_row(spark):
    from quire.operators import ledger as led

    items = spark.createDataFrame([(1, "s", "u", None), (None, "s", "u", None), (2, "s", None, None)],
                                  "seq long, source_id string, source_url string, modified_at timestamp")
    assert sorted((r.seq or 0, r.accepted) for r in led.decide(items).collect()) == [(0, False), (1, True), (2, False)]


def test_unnumbered_items_behind_a_shuffle(spark):
    """Items without seq out of a groupBy: every output sees the same numbers."""
    rows = spark.range(6000).selectExpr("concat('u/', id % 4000) AS source_url", "'text' AS kind", "concat('s', id % 3) AS source_id",
                                        "CAST(NULL AS timestamp) AS modified_at", "concat('t', id) AS text")
    items = rows.groupBy("source_url", "kind", "source_id", "modified_at").agg(F.max("text").alias("text"))
    n = items.count()
    routes = spark.createDataFrame([("s0", 1, 2)], "source_id string, project_id long, dataset_id long")
    for persist in (False, True):
        res = ing.ingest(items, None, routes, trainer=False, persist=persist)
        docs, rejects = res.documents.count(), res.rejects.count()
        assert docs == 4000 and docs + rejects == n and res.passthrough.count() == 0
        assert res.ledger.count() == 4000
        res.decided.unpersist()
    again = [sorted((r.source_url, r.text) for r in ing.ingest(items, None, routes).documents.collect()) for _ in range(2)]
    assert again[0] == again[1]


def test_some_items_without_number(spark):
    items = spark.createDataFrame([(5, "text", "s", "u", "late", None), (None, "text", "s", "u", "none", None), (2, "text", "s", "u", "first", None)],
                                  "seq long, kind string, source_id string, source_url string, text string, modified_at timestamp")
    res = ing.ingest(items, None, spark.createDataFrame([], "source_id string, project_id long, dataset_id long"))
    assert [r.text for r in res.documents.collect()] == ["first"] and res.rejects.count() == 2
