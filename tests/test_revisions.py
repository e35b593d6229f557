"""Line changes between versions."""

import random

from pyspark.sql import functions as F

from quire.operators import revisions as rv


def test_changes_give_the_next_version():
    rng = random.Random(3)
    for _ in range(400):
        old = "\n".join(rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(rng.randint(0, 12)))
        lines = old.split("\n")
        for _ in range(rng.randint(0, 5)):
            kind, i = rng.random(), rng.randrange(len(lines) + 1)
            if kind < 0.4:
                lines.insert(i, rng.choice(["new", "a", ""]))
            elif lines and kind < 0.7:
                lines.pop(i % len(lines))
            elif lines:
                lines.insert(i % len(lines), lines.pop(rng.randrange(len(lines))))
        new = "\n".join(lines) if lines else None
        changes = rv.line_changes(old, new)
        assert rv.apply_changes(old, changes) == new
        before, after = old.split("\n"), lines
        left = {x: before.count(x) - after.count(x) for x in set(before) | set(after)}
        assert sum(c["op"] == "removed" for c in changes) == sum(max(n, 0) for n in left.values())
        assert sum(c["op"] == "added" for c in changes) == sum(max(-n, 0) for n in left.values())


def test_only_what_changed():
    old = "a\nb\nc\nd\ne"
    assert rv.line_changes(old, old) == []
    assert rv.line_changes(old, "a\nb\nx\nd\ne") == [{"op": "added", "old_line": None, "new_line": 2, "line": "x"},
                                                    {"op": "removed", "old_line": 2, "new_line": None, "line": "c"}]
    assert rv.line_changes(old, "b\nc\nd\ne\na") == [{"op": "moved", "old_line": 0, "new_line": 4, "line": "a"}]
    assert rv.line_changes("x\nx\nx", "x\nx") == [{"op": "removed", "old_line": 2, "new_line": None, "line": "x"}]
    assert len(rv.line_changes(None, "a\nb")) == 2 and rv.apply_changes(None, rv.line_changes(None, "a\nb")) == "a\nb"
    assert rv.apply_changes("a", rv.line_changes("a", None)) is None


def test_versions_meet_by_number(spark):
    rows = [("u", 1, "a\nb"), ("u", 2, "b\na"), ("u", 3, "b\nc"), ("v", 1, None), ("v", 2, "x"), ("w", 1, "only"), ("z", 2, "a"), ("z", 4, "b")]
    pairs = rv.compared(spark.createDataFrame(rows, "url string, version int, text string"))
    assert all(r.ok for r in pairs.select(rv.applied("old", "changes").eqNullSafe(F.col("new")).alias("ok")).collect())
    got = sorted((r.url, r.version, r.op, r.line) for r in rv.audit(pairs).collect())
    assert got == [("u", 1, "moved", "a"), ("u", 2, "added", "c"), ("u", 2, "removed", "a"), ("v", 1, "added", "x")]
