"""K1-K4, K12 write-then-read: versioned tables, appends, partition overwrite, stand-off files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quire.session import scratch_path
from quire.sinks import standoff, tables


def test_versioned_table_reads_newest_complete(spark):
    t = tables.VersionedTable(scratch_path(spark, "vt"))
    assert t.read(spark) is None
    led = spark.createDataFrame([("b", "u2", dt.datetime(2024, 2, 1)), ("a", "u1", dt.datetime(2024, 1, 1))],
                                "source_id string, url string, modified_at timestamp")
    tables.write_ledger(t, led, 0)
    tables.write_ledger(t, led.where("source_id = 'a'"), 1)
    os.makedirs(f"{t.path}/v=2")  # a crashed write: no _SUCCESS, never read
    assert t.versions(spark) == [0, 1]
    assert t.read(spark).count() == 1
    assert t.read(spark, before=1).count() == 2
    # Rows sorted by (source_id, modified_at) within each file
    many = spark.range(200).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source_id"),
                                   F.col("id").cast("string").alias("url"),
                                   F.timestamp_seconds(F.col("id") * 7919 % 1000).alias("modified_at"))
    tables.write_ledger(t, many.repartition(4), 3)
    rows = spark.read.parquet(f"{t.path}/v=3").select(F.input_file_name().alias("f"), "source_id", "modified_at").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append((r.source_id, r.modified_at))
    assert len(by_file) > 1 and all(v == sorted(v) for v in by_file.values())


def test_append_and_dynamic_overwrite(spark):
    path = scratch_path(spark, "docs")
    d1 = spark.createDataFrame([("t1", 1), ("t2", 2)], "text string, project_id long")
    tables.append_documents(d1, path)
    tables.append_documents(spark.createDataFrame([("t3", 1)], "text string, project_id long"), path)
    assert spark.read.parquet(path).where("project_id = 1").count() == 2  # K2 append, S5 pruned read
    dpath = scratch_path(spark, "dict")
    items = spark.createDataFrame([("element", "e1", "E"), ("class", "c1", "C")], "item_type string, item_id string, name string")
    tables.overwrite_partitions(items, dpath, ["item_type"])
    tables.overwrite_partitions(spark.createDataFrame([("element", "e2", "E2")], items.schema), dpath, ["item_type"])
    got = sorted((r.item_type, r.item_id) for r in spark.read.parquet(dpath).collect())
    assert got == [("class", "c1"), ("element", "e2")]  # K3: only the touched partition was rewritten


def test_standoff_files(spark):
    target = scratch_path(spark, "standoff-files")
    docs = spark.createDataFrame([(1, "src", "hello"), (2, "src", "wörld")], "doc_id long, source_id string, text string")
    man = standoff.export(docs, target, run_ts=F.lit("2024-01-02 03:04:05").cast("timestamp")).collect()
    assert sorted(r.n_chars for r in man) == [5, 5]
    for r in man:
        assert r.file_name.startswith("src_20240102030405_")
        assert os.path.getsize(f"{target}/{r.file_name}.ann") == 0
    texts = sorted(open(f"{target}/{r.file_name}.txt", encoding="utf-8").read() for r in man)
    assert texts == ["hello", "wörld"]
