"""U1 ledger: fixture F1/F2 sequences, loop-equivalence property (also on
the chunked skew path), state, high-water mark, refresh decisions."""

import datetime as dt
import random

import pytest

from quire.operators import ledger as led

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)
SCHEMA = "seq long, source_id string, source_url string, modified_at timestamp"
LEDGER = "source_id string, url string, modified_at timestamp"


def loop(items, prior=None, policy="different"):
    """The reference's item-by-item rule, as plain Python."""
    state = dict(prior or {})  # url -> (source, time); absent = not in dict
    out = []
    for seq, src, url, m in sorted(items):
        if url not in state:
            ok = True
        elif m is None or state[url][1] is None:
            ok = False
        else:
            ok = m != state[url][1] if policy == "different" else m > state[url][1]
        if ok:
            state[url] = (src, m)
            out.append(seq)
    return out, state


def accepted(spark, rows, prior=None, **kw):
    items = spark.createDataFrame(rows, SCHEMA)
    ledger = spark.createDataFrame([(s, u, m) for u, (s, m) in prior.items()], LEDGER) if prior else None
    return sorted(r.seq for r in led.accept(items, ledger, **kw).collect())


def test_fixture_sequences(spark):
    rows = [
        (1, "a", "u1", T1), (2, "a", "u1", T1), (3, "a", "u1", T2), (4, "a", "u1", T1),  # keep 1,3,4
        (5, "a", "u2", T2), (6, "a", "u2", T1),  # older wins too: keep both
        (7, "a", "u3", None), (8, "a", "u3", T1),  # keep only the null row
        (9, "a", "u4", T1), (10, "a", "u4", None),  # keep only t1
        (11, "a", "u5", None), (12, "a", "u5", None),  # keep the first
    ]
    assert accepted(spark, rows) == [1, 3, 4, 5, 6, 7, 9, 11]


def test_prior_state(spark):
    prior = {"known": ("s1", T1), "frozen": ("s1", None)}
    rows = [(1, "s2", "known", T1), (2, "s2", "known", T2), (3, "s2", "frozen", T2), (4, "s2", "new", None)]
    assert accepted(spark, rows, prior) == [2, 4]
    items = spark.createDataFrame(rows, SCHEMA)
    ledger = spark.createDataFrame([(s, u, m) for u, (s, m) in prior.items()], LEDGER)
    state = {r.url: (r.source_id, r.modified_at) for r in led.apply(ledger, led.decide(items, ledger)).collect()}
    assert state == {"known": ("s2", T2), "frozen": ("s1", None), "new": ("s2", None)}


@pytest.mark.parametrize("chunk", [led.DEFAULT_CHUNK, 3])
@pytest.mark.parametrize("policy", ["different", "newer"])
def test_equals_loop(spark, chunk, policy):
    rnd = random.Random(7 + chunk)
    times = [None, T1, T2, dt.datetime(2024, 3, 1)]
    rows = [(i, f"s{rnd.randrange(3)}", f"u{rnd.randrange(12)}", rnd.choice(times)) for i in range(400)]
    rnd.shuffle(rows)
    prior = {f"u{k}": ("s0", rnd.choice(times)) for k in range(0, 12, 3)}
    want, _ = loop(rows, prior, policy)
    assert accepted(spark, rows, prior, policy=policy, chunk=chunk) == sorted(want)


def test_hot_url_chunked_equals_unchunked(spark):
    """One URL holding most rows: the chunked scan decides exactly like one window."""
    rnd = random.Random(3)
    times = [None, T1, T2]
    rows = [(i, "s", "hot" if rnd.random() < 0.8 else f"u{i % 5}", rnd.choice(times)) for i in range(1000)]
    assert accepted(spark, rows, chunk=17) == accepted(spark, rows)
    assert accepted(spark, rows, chunk=17) == sorted(loop(rows)[0])


def test_second_run_accepts_nothing(spark):
    rows = [(i, "s", f"u{i}", T1 if i % 2 else None) for i in range(20)]
    items = spark.createDataFrame(rows, SCHEMA)
    state = led.apply(None, led.decide(items))
    assert led.accept(items, state).count() == 0


def test_high_water_mark(spark):
    ledger = spark.createDataFrame([("a", "u1", T1), ("a", "u2", T2), ("b", "u3", None)], LEDGER)
    got = {r.source_id: (r.high_water_mark, r.start_date) for r in led.high_water_mark(ledger).collect()}
    assert got == {"a": (T2, "2024-02-01"), "b": (None, None)}


def test_refresh_plan(spark):
    ledger = spark.createDataFrame([("a", "timed", dt.datetime(2024, 1, 2, 3, 4, 5)), ("a", "untimed", None)], LEDGER)
    frontier = spark.createDataFrame([
        ("timed", False, False), ("timed2", False, True), ("untimed", False, True), ("new", False, False),
    ], "url string, force_refresh boolean, dont_refresh boolean")
    frontier = frontier.unionByName(spark.createDataFrame([("timed", True, True)], frontier.schema))
    ledger2 = ledger.unionByName(spark.createDataFrame([("a", "timed2", T1)], LEDGER))
    got = sorted((r.url, r.force_refresh, r.action, r.if_modified_since)
                 for r in led.refresh_plan(frontier, ledger2).collect())
    assert got == [
        ("new", False, "fetch", None),
        ("timed", False, "conditional", "Tue, 02 Jan 2024 03:04:05 +0000"),
        ("timed", True, "fetch", None),
        ("timed2", False, "skip", None),
        ("untimed", False, "fetch", None),
    ]


def test_skip_known(spark):
    ledger = spark.createDataFrame([("a", "held", T1), ("a", "nulltime", None)], LEDGER)
    fr = spark.createDataFrame([("held",), ("nulltime",), ("new",)], "url string")
    assert sorted(r.url for r in led.skip_known(fr, ledger).collect()) == ["new", "nulltime"]


def test_versions_chunked(spark):
    rows = [(i, "s", "u" if i % 3 else "v", T1 if i % 2 else T2) for i in range(60)]
    d = led.decide(spark.createDataFrame(rows, SCHEMA))
    a = {r.seq: r.version for r in led.versions(d).collect()}
    b = {r.seq: r.version for r in led.versions(d, chunk=4).collect()}
    assert a == b and max(a.values()) > 10


def test_since_mark(spark):
    feed = spark.createDataFrame([(1, "a", "x", T1), (2, "a", "y", T2), (3, "b", "z", T1)], SCHEMA)
    marks = spark.createDataFrame([("a", "2024-02-01")], "source_id string, start_date string")
    assert sorted(r.seq for r in led.since_mark(feed, marks).collect()) == [2, 3]
