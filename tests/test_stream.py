"""T1/T2/T7 streaming ingest: k micro-batches equal one batch; a replayed
batch decides exactly like its first attempt."""

import datetime as dt

from quire.operators import ledger as led
from quire.session import scratch_path
from quire.streaming import ingest as si

SCHEMA = "seq long, kind string, source_id string, source_url string, modified_at timestamp"


def test_stream_equals_batch_and_replay(spark):
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    rows = [(i, "text", "s", f"u{i % 7}", times[(i * 5) % 3]) for i in range(90)]
    feed = spark.createDataFrame(rows, SCHEMA)
    root = scratch_path(spark, "streamtest")
    for k in range(3):  # three arrivals, in order
        feed.where(f"seq >= {k * 30} AND seq < {(k + 1) * 30}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stores = si.StreamStores(root)
    si.run(spark, f"{root}/in", feed.schema, stores, max_files_per_trigger=1)
    got = sorted(r.seq for r in si.accepted_documents(spark, stores).collect())
    assert got == sorted(r.seq for r in led.accept(feed).collect())
    want_state = {tuple(r) for r in led.apply(None, led.decide(feed)).select("source_id", "url", "modified_at").collect()}
    assert {tuple(r) for r in si.ledger_state(spark, stores).collect()} == want_state
    # replay batch 1: it must read ledger v=0 and write the same rows again
    batch1 = lambda: sorted(r.seq for r in si.read_target(spark, stores, "accepted").where("batch = 1").collect())
    before = batch1()
    si.process_batch(feed.where("seq >= 30 AND seq < 60"), 1, stores)
    assert batch1() == before
    assert si.remove_uncommitted(spark, stores) > 0 and batch1() == before
    assert si.remove_uncommitted(spark, stores) == 0


def test_ordered_release_across_batches(spark):
    import json as _json

    from quire.streaming import release as rs

    def art(text):
        return _json.dumps({"dateModified": "2024-01-01T00:00:00+00:00",
                            "mainEntityOfPage": [{"name": "markdown", "text": text}]})

    schema = "url string, status int, body string, page_no long, position long, arrival long"
    files = [
        [("u1", 200, art("one"), 1, 1, 1), ("u2", 200, art("two"), 1, 2, 2)],   # slot 0 missing: all wait
        [("u0", 200, art("zero"), 1, 0, 3)],                                     # releases 0, 1, 2
        [("u3", 200, art("three"), 1, 3, 4), ("u1b", 200, art("late"), 1, 1, 5)],  # 3 released; 1 already was
    ]
    root = scratch_path(spark, "releasetest")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{root}/in")
    stores = rs.ReleaseStores(root)
    rs.run(spark, f"{root}/in", spark.createDataFrame([], schema).schema, stores)
    items = spark.read.parquet(stores.items).orderBy("seq").collect()
    assert [r.source_url for r in items] == ["u0", "u1", "u2", "u3"]
    assert [r.html for r in items] == ["zero", "one", "two", "three"]
    rej = [(r.url, r.reason) for r in spark.read.parquet(stores.rejects).collect()]
    assert rej == [("u1b", "slot already released")]


def test_incremental_scheduled_runs(spark):
    """A second AvailableNow run takes only the files that arrived
    since the first run; together they equal one batch."""
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    rows = [(i, "text", "s", f"u{i % 4}", times[(i * 2) % 3]) for i in range(40)]
    feed = spark.createDataFrame(rows, SCHEMA)
    root = scratch_path(spark, "incremental")
    stores = si.StreamStores(root)
    feed.where("seq < 20").coalesce(1).write.mode("append").parquet(f"{root}/in")
    si.run(spark, f"{root}/in", feed.schema, stores)
    first = si.accepted_documents(spark, stores).count()
    feed.where("seq >= 20").coalesce(1).write.mode("append").parquet(f"{root}/in")
    si.run(spark, f"{root}/in", feed.schema, stores)  # the next scheduled run
    assert si.ledger_state(spark, stores).count() == 4
    got = sorted(r.seq for r in si.accepted_documents(spark, stores).collect())
    assert got == sorted(r.seq for r in led.accept(feed).collect()) and len(got) > first



def test_ledger_layouts_agree_with_compaction(spark):
    """The log layout (deltas + compaction every 2 batches) and the
    full-version layout give the same documents and the same ledger."""
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)]
    rows = [(i, "text", f"s{i % 2}", f"u{(i * 7) % 9}", times[(i * 5) % 4]) for i in range(100)]
    feed = spark.createDataFrame(rows, SCHEMA)
    results = {}
    for layout in ("log", "versions"):
        root = scratch_path(spark, f"layout-{layout}")
        stores = si.StreamStores(root)
        for b in range(5):
            part = feed.where(f"seq >= {b * 20} AND seq < {(b + 1) * 20}")
            si.process_batch(part, b, stores, layout=layout, compact_every=2)
        docs = sorted(r.seq for r in si.accepted_documents(spark, stores).collect())
        state = {tuple(r) for r in si.ledger_state(spark, stores, layout).select("source_id", "url", "modified_at").collect()}
        results[layout] = (docs, state)
    assert results["log"] == results["versions"]
    assert results["log"][0] == sorted(r.seq for r in led.accept(feed).collect())


def test_every_target_and_bad_rows(spark):
    """Rejects, passthrough, documents, dictionary and links per batch; nothing vanishes."""
    schema = ("seq long, kind string, source_id string, source_url string, text string, item_type string, item_id string, name string, "
              "links array<struct<link_type:string,item_type:string,item_id:string>>, modified_at timestamp")
    link = [(None, "attribute", "a1")]
    rows = [(1, "text", "s", "u1", "t", None, None, None, None, None), (2, "text", "s", None, "t", None, None, None, None, None),
            (3, "text", "s", "u" * 300, "t", None, None, None, None, None), (4, None, "s", "u4", "t", None, None, None, None, None),
            (5, "dictionary", "s", "u5", None, "element", "e1", "E", link, None), (None, "text", "s", "u6", "t", None, None, None, None, None),
            (7, "text", "s", "u1", "again", None, None, None, None, None)]
    stores = si.StreamStores(scratch_path(spark, "targets"))
    for b, part in enumerate((rows[:4], rows[4:])):
        si.process_batch(spark.createDataFrame(part, schema), b, stores)
    count = lambda name: si.read_target(spark, stores, name).count()
    assert {n: count(n) for n in si.TARGETS} == {"rejects": 3, "passthrough": 1, "documents": 2, "dictionary": 1, "links": 1,
                                                 "trainer": 2, "accepted": 3}
    assert {r.reason for r in si.read_target(spark, stores, "rejects").collect()} == {"missing source_url", "source_url too long", "unchanged"}


def test_ledger_log_reads_touched_buckets_and_removes_old(spark):
    from quire.sinks.files import finished_folders
    from quire.sinks.ledger_log import LedgerLog

    log = LedgerLog(scratch_path(spark, "buckets"), buckets=8)
    rows = spark.range(200).selectExpr("'s' AS source_id", "concat('u', id) AS url", "CAST(NULL AS timestamp) AS modified_at")
    for b in range(6):
        log.append_delta(rows.where(f"pmod(int(substr(url, 2)), 6) = {b}"), b)
        if b in (1, 3, 5):
            log.compact(spark, b)
    assert log.base.versions(spark) == [3, 5] and finished_folders(spark, log.delta_path, "batch=") == [4, 5]
    assert log.state(spark).count() == 200 and log.state(spark, before=5).count() == 200 - 33
    one = log.rows_for(spark, spark.createDataFrame([("u7",), (None,)], "url string"))
    assert [r.url for r in one.collect()] == ["u7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_broken_batch_is_invisible(spark):
    """A batch that breaks at any of its writes shows nothing, in targets
    and ledger; its replay shows everything once."""
    import pytest

    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)]
    feed = spark.createDataFrame([(i, "text", "s", f"u{i % 6}", times[(i * 5) % 3]) for i in range(30)], SCHEMA)
    stores = si.StreamStores(scratch_path(spark, "broken"))
    si.process_batch(feed.where("seq < 15"), 0, stores)
    first = {n: si.read_target(spark, stores, n).count() for n in ("rejects", "documents", "accepted")}
    state = {tuple(r) for r in si.ledger_state(spark, stores).collect()}

    class Broken(si.StreamStores):
        lost = ""

        def target(self, name):
            if name == self.lost:
                raise OSError("lost")
            return super().target(name)

        @property
        def commits(self):
            if self.lost == "commits":
                raise OSError("lost")
            return super().commits

    for lost in ("passthrough", "accepted", "commits"):
        bad = Broken(stores.root)
        bad.lost = lost
        with pytest.raises(OSError):
            si.process_batch(feed.where("seq >= 15"), 1, bad)
        assert {n: si.read_target(spark, stores, n).count() for n in first} == first
        assert {tuple(r) for r in si.ledger_state(spark, stores).collect()} == state
    si.process_batch(feed.where("seq >= 15"), 1, stores)
    got = sorted(r.seq for r in si.accepted_documents(spark, stores).collect())
    assert got == sorted(r.seq for r in led.accept(feed).collect())
    assert si.read_target(spark, stores, "documents").count() == len(got)


def test_commit_records_replace_each_other(spark):
    from quire.sinks.commits import CommitLog

    log = CommitLog(scratch_path(spark, "records"))
    assert log.records(spark) == {} and log.last(spark) is None
    log.write(spark, 1, {"a": "x/1"})
    log.write(spark, 0, {"a": "x/0", "b": "y/0"})
    log.write(spark, 1, {"a": "x/2"})
    assert log.folders(spark, "a") == ["x/0", "x/2"] and log.folders(spark, "b") == ["y/0"] and log.folders(spark, "a", before=1) == ["x/0"]
    assert log.last(spark) == 1


def test_release_keeps_rows_without_slots(spark):
    """T4: null and negative slots are rejected in whichever batch they come; the rest is released."""
    import json as _json

    from quire.streaming import release as rs

    def art(text):
        return _json.dumps({"dateModified": "2024-01-01T00:00:00+00:00", "mainEntityOfPage": [{"name": "markdown", "text": text}]})

    schema = "url string, status int, body string, page_no long, position long, arrival long"
    batches = [[("u1", 200, art("one"), 1, 1, 1), ("n1", 200, art("x"), 1, None, 2), ("n2", 200, art("x"), None, 0, 2)],
               [("u0", 200, art("zero"), 1, 0, 3), ("n3", 200, art("x"), 1, -1, 3)], [("n4", 200, art("x"), 1, None, 4), ("u2", 200, art("two"), 1, 2, 4)]]
    stores = rs.ReleaseStores(scratch_path(spark, "slots"))
    for b, rows in enumerate(batches):
        rs.process_batch(spark.createDataFrame(rows, schema), b, stores, "s")
    assert [r.html for r in spark.read.parquet(stores.items).orderBy("seq").collect()] == ["zero", "one", "two"]
    assert sorted((r.url, r.reason) for r in spark.read.parquet(stores.rejects).collect()) == [(f"n{i}", "no slot") for i in range(1, 5)]
