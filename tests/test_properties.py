"""Hypothesis property tests: the set-wise ledger equals the item-by-item
loop for any feed and prior state, on both the plain and the chunked path."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.operators import ledger as led
from test_ledger import LEDGER, SCHEMA, loop

TIMES = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)]

feeds = st.lists(st.tuples(st.sampled_from(["s0", "s1"]), st.sampled_from(["a", "b", "c"]), st.sampled_from(TIMES)),
                 min_size=1, max_size=25)
priors = st.dictionaries(st.sampled_from(["a", "b", "c"]), st.tuples(st.just("s9"), st.sampled_from(TIMES)), max_size=3)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feed=feeds, prior=priors, chunk=st.sampled_from([2, 5, 1 << 20]), policy=st.sampled_from(["different", "newer"]))
def test_ledger_equals_loop(spark, feed, prior, chunk, policy):
    rows = [(i, s, u, m) for i, (s, u, m) in enumerate(feed)]
    items = spark.createDataFrame(rows, SCHEMA)
    ledger = spark.createDataFrame([(s, u, m) for u, (s, m) in prior.items()], LEDGER) if prior else None
    decided = led.decide(items, ledger, policy=policy, chunk=chunk)
    want, state = loop(rows, prior, policy)
    assert sorted(r.seq for r in decided.where("accepted").collect()) == sorted(want)
    got_state = {r.url: (r.source_id, r.modified_at) for r in led.apply(ledger, decided).collect()}
    assert got_state == state
