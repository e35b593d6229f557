"""W2/W3 ordered release and the chunked running aggregate."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators.ordering import first_by, ordered_release, running


def test_running_chunked_equals_window(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(4)}", i, rnd.randrange(100)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.o: (r.mx, r.sm, r.n) for r in df.select("o", F.max("v").over(w).alias("mx"),
                                                       F.sum("v").over(w).alias("sm"),
                                                       F.count("v").over(w).alias("n")).collect()}
    vals = {"mx": ("max", "v"), "sm": ("sum", "v"), "n": ("count", "v")}
    for chunk in (7, 1 << 20):
        got = {r.o: (r.mx, r.sm, r.n) for r in running(df, ["k"], "o", vals, chunk).collect()}
        assert got == want


def test_ordered_release(spark):
    # page 1: slots 0,1,2 arrive 3,1,2 -> all released at 3; slot 1 delivered twice (arrival 9 rejected)
    # page 2: slot 0 and slot 2 (slot 1 never arrives) -> slot 2 pending
    rows = [(1, 0, 3), (1, 1, 1), (1, 2, 2), (1, 1, 9), (2, 0, 5), (2, 2, 4)]
    df = spark.createDataFrame(rows, "page_no long, position long, arrival long")
    got = sorted((r.page_no, r.position, r.arrival, r.status, r.release_at) for r in ordered_release(df, chunk=2).collect())
    assert got == [(1, 0, 3, "released", 3), (1, 1, 1, "released", 3), (1, 1, 9, "rejected", None),
                   (1, 2, 2, "released", 3), (2, 0, 5, "released", 5), (2, 2, 4, "pending", None)]


def test_first_by(spark):
    df = spark.createDataFrame([(1, "2-HIGH", 5), (1, "1-URGENT", 7), (1, "1-URGENT", 6), (2, "3", 1)],
                               "c long, p string, k long")
    got = {r.c: (r.k, r.n) for r in first_by(df, ["c"], ["p", "k"], ["k"]).collect()}
    assert got == {1: (6, 3), 2: (1, 1)}


def test_equal_arrivals_fill_a_slot_once(spark):
    rows = [(1, 0, 5, "a"), (1, 0, 5, "b"), (1, 0, 5, "b"), (1, 1, 5, "c"), (1, 2, 1, "d"), (2, 1, 3, "e"), (2, 1, 3, "e")]
    df = spark.createDataFrame(rows, "page_no long, position long, arrival long, name string")
    got = ordered_release(df, tie=["name"]).collect()
    assert len(got) == len(rows)
    by = sorted((r.page_no, r.position, r.name, r.status) for r in got)
    assert by == [(1, 0, "a", "released"), (1, 0, "b", "rejected"), (1, 0, "b", "rejected"), (1, 1, "c", "released"),
                  (1, 2, "d", "released"), (2, 1, "e", "pending"), (2, 1, "e", "rejected")]
    assert sorted(r.status for r in ordered_release(df).collect()) == sorted(s for *_, s in by)


def test_every_row_comes_out(spark):
    """Null pages and positions, positions before the first slot, null
    arrivals and identical rows: all come out, none holds up the others."""
    rows = [(1, 0, 3, "a"), (1, None, 1, "b"), (None, 0, 1, "c"), (None, None, None, "d"), (1, -1, 1, "e"), (1, 1, None, "f"), (1, 1, None, "f"),
            (1, 1, None, "f"), (1, 2, 2, "g"), (2, 0, None, "h"), (2, 0, 7, "i")]
    df = spark.createDataFrame(rows, "page_no long, position long, arrival long, name string").repartition(4)
    for chunk in (2, 1 << 20):
        got = ordered_release(df, chunk=chunk).collect()
        assert sorted(map(str, [(r.page_no, r.position, r.arrival, r.name) for r in got])) == sorted(map(str, rows))
        status = sorted((r.name, r.status) for r in got)
        assert status == [("a", "released"), ("b", "rejected"), ("c", "rejected"), ("d", "rejected"), ("e", "rejected"), ("f", "rejected"),
                          ("f", "rejected"), ("f", "released"), ("g", "released"), ("h", "rejected"), ("i", "released")]
