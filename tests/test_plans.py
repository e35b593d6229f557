"""Plan checks: native queries stay in the JVM, scans are pruned, the
ledger shuffles its wide rows once."""

import pytest

from quire.plans import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["html_to_text", "ledger_accept", "page_links", "annotate_terms",
                                  "link_replace", "ingest_pages", "sentence_terms", "markdown_text", "news_requests", "news_ingest",
                                  "term_codes", "annotation_levels", "annotator_kappa"])
def test_no_python_in_native_queries(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["annotate_terms"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_ledger_wide_rows_shuffled_once(spark):
    from quire.plans import standins as S
    from quire.operators import ledger as led

    plan = _plan(led.accept(S.events_feed(spark, SF).drop("props")))
    # the wide feed: one exchange on (url, chunk); the summary side adds its own
    # narrow exchanges (partial aggregates and one row per chunk)
    wide = [l for l in plan.splitlines() if "Exchange hashpartitioning(_url" in l and "_chunk" in l]
    assert len(wide) <= 2


def test_large_batch_filters_the_store_before_its_exchange(spark):
    """Beyond the broadcast bound the stored table meets the Bloom words (a
    broadcast join) below the exchange of the exact join."""
    from quire.session import keyed_filter

    store = spark.range(50_000).selectExpr("concat('u', id) AS url", "id AS v")
    keys = spark.range(0, 50_000, 500).selectExpr("concat('u', id) AS url")
    semi = keyed_filter(store, keys, "url", "left_semi", 10)
    anti = keyed_filter(store, keys, "url", "left_anti", 10)
    assert sorted(r.v for r in semi.collect()) == list(range(0, 50_000, 500)) and anti.count() == 49_900
    assert anti.intersect(semi).count() == 0
    plan = _plan(semi)
    store_side = plan[plan.index("LeftSemi"):]
    assert store_side.index("_maybe") < store_side.index("BroadcastHashJoin") if "_maybe" in store_side else "BroadcastHashJoin" in store_side
    passed = store.sparkSession.createDataFrame([(None, 1), ("u0", 2)], "url string, v long")
    assert keyed_filter(passed, keys, "url", "left_anti", 10).count() == 1


def test_bloom_lets_few_others_through(spark):
    from quire.operators import bloom

    rows = bloom.marked(spark.range(100_000).selectExpr("id AS k"), spark.range(5_000).selectExpr("id * 7 AS k"), ["k"], words=4096)
    inside = rows.where("k % 7 = 0 AND k < 35000")
    assert inside.where("NOT _maybe").count() == 0
    assert rows.where("_maybe").count() < 5_000 + 2_000


def test_stores_by_key_join_without_exchange(spark):
    """K3, K4: links by target meet the dictionary bucket by bucket, and so do
    links by source; an update shuffles the batch, not the stored table."""
    from quire.plans.history import keyed_store
    from quire.operators import dictionary as dct

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = keyed_store(spark, SF)
        for df in (store.resolved(spark, 1), dct.links_with_source(store.links.read(spark, 1), store.items.read(spark, 1))):
            plan = _plan(df)
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
