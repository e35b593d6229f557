"""What keeps joins, batches and tasks bounded as tables grow (findings of round 3)."""

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from quire.operators import bloom
from quire.operators import dictionary as dct
from quire.operators import frontier as fr
from quire.operators import ledger as led
from quire.operators import revisions as rv
from quire.plans.store import _dictionary_pages
from quire.session import cut_lineage
from quire.sinks import standoff
from quire.sources import extractors as ex
from quire.sources import html_pages as hp


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_never_broadcast(spark, monkeypatch):
    """whole pages made by an expression look tiny to the planner."""
    pages = spark.range(20).selectExpr("concat('u', id) AS url", "repeat('x', 1000) AS html")
    wanted = spark.range(0, 20, 2).selectExpr("concat('u', id) AS url", "id AS item_id")
    monkeypatch.setattr(ex, "MAX_BROADCAST_REQUESTS", 0)
    out = ex.carry_request_fields(pages, wanted, ["item_id"]).where("item_id IS NOT NULL")
    assert "Broadcast" not in _plan(out)
    assert sorted(r.item_id for r in out.collect()) == list(range(0, 20, 2))


def test_walk_broadcasts_neither_edges_nor_seen_nodes(spark, monkeypatch):
    """only a frontier counted to be small may be broadcast."""
    plans, cut = [], fr.cut_lineage
    monkeypatch.setattr(fr, "cut_lineage", lambda df: plans.append(_plan(df)) or cut(df))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (1, 4), (4, 5)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    for bound in (fr.MAX_BROADCAST_FRONTIER, 0):
        monkeypatch.setattr(fr, "MAX_BROADCAST_FRONTIER", bound)
        plans.clear()
        assert {r.node: r.depth for r in fr.walk(seeds, edges).collect()} == {1: 0, 2: 1, 4: 1, 3: 2, 5: 2}
        assert all(p.count("BroadcastHashJoin") <= (1 if bound else 0) for p in plans)
        assert any("SortMergeJoin" in p for p in plans)


def test_ledger_decision_sends_no_rows_through_the_driver(spark):
    """the accepted rows are not broadcast to the items; the filter of keys has 8 MB."""
    rows = spark.range(50).selectExpr("id AS seq", "concat('u', id % 7) AS source_url", "'s' AS source_id",
                                      "timestamp_ntz'2024-01-01 00:00:00' AS modified_at")
    out = led.decide(rows)
    assert "SortMergeJoin" in _plan(out).split("BroadcastHashJoin")[0]
    assert out.where("accepted").count() == 7
    assert bloom.WORDS * 16 <= 8 << 20


@pytest.mark.parametrize("call", ["compared", "review_blocks", "export"])
def test_texts_go_to_python_in_bounded_batches(spark, tmp_path, call):
    """a batch holds a few hundred rows and some megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a\nb").alias("text"), F.lit("s").alias("source_id"))
    if call == "compared":
        rv.compared(docs.select("doc_id", F.lit(1).alias("version"), "text"), key="doc_id")
    elif call == "review_blocks":
        hp.review_blocks(docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html")))
    else:
        standoff.export(docs, str(tmp_path), run_ts=F.lit("2024-01-01").cast("timestamp"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 8 << 20


def test_dictionary_pages_are_made_by_all_tasks(spark):
    """a small file of parts is one split, its pages are the work of many."""
    pages = _dictionary_pages(spark, SF001)
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_review_pages_are_parsed_once(spark):
    """Items, their numbering and rejects read the blocks that were cut out once."""
    pages = spark.createDataFrame([(1, "u", "<main></main>")], "page_id long, url string, html string")
    for df in ex.review_items(pages):
        assert "Python" not in _plan(df)


def test_ledger_summaries_are_never_broadcast(spark):
    """FINDINGS_r04 F1: a summary row per URL and chunk, as many as the batch has URLs."""
    rows = cut_lineage(spark.range(12).selectExpr(
        "id AS seq", "concat('u', id % 3) AS source_url", "'s' AS source_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id div 6 AS int)) AS modified_at"))
    out = led.decide(rows, chunk=4)
    assert "Broadcast" not in _plan(out)
    assert sorted(r.seq for r in out.where("accepted").collect()) == [0, 1, 2, 6, 7, 8]


def test_dictionary_keys_are_never_broadcast(spark):
    """FINDINGS_r04 F1: the latest items of a batch are not sent to its edges."""
    link = "struct(cast(null AS string) AS link_type, 'class' AS item_type, concat('d', id) AS item_id)"
    items = cut_lineage(spark.range(6).selectExpr(
        "'element' AS item_type", "concat('p', id % 4) AS item_id", "id AS seq", f"array({link}) AS links"))
    out = dct.replace_links(None, items)
    assert "Broadcast" not in _plan(out)
    assert sorted((r.src_item_id, r.dst_item_id) for r in out.collect()) == [("p0", "d4"), ("p1", "d5"), ("p2", "d2"), ("p3", "d3")]
