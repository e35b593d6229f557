"""What changed between versions of a document (R1 audit).

Successive versions of a URL meet by an equi join on (url, version), so a URL
with many versions is spread over tasks. Two versions are compared line by
line: equal lines at both ends of a region match; lines that occur once on
either side are anchors, the longest run of anchors in the same order splits
the region, and what lies between them is compared in the same way. Lines left
over on both sides with the same content have moved, the others were removed
or added. Applying the changes to a version gives the next one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict, deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import bounded_batches

CHANGE = T.StructType([T.StructField("op", T.StringType()), T.StructField("old_line", T.IntegerType()),
                       T.StructField("new_line", T.IntegerType()), T.StructField("line", T.StringType())])


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest rising run of distinct numbers."""
    tails, ends, back = [], [], []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        tails[k:k + 1] = [p]
        ends[k:k + 1] = [i]
        back.append(ends[k - 1] if k else -1)
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def matched_lines(old: list[str], new: list[str]) -> list[tuple[int, int]]:
    """Pairs (old line, new line) that stay in place."""
    pairs, regions = [], [(0, len(old), 0, len(new))]
    while regions:
        a, b, c, d = regions.pop()
        while a < b and c < d and old[a] == new[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and old[b - 1] == new[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        left, right = Counter(old[a:b]), Counter(new[c:d])
        place = {x: c + k for k, x in enumerate(new[c:d])}
        anchors = [(k, place[old[k]]) for k in range(a, b) if left[old[k]] == 1 and right[old[k]] == 1]
        if not anchors:
            continue
        cut = [anchors[i] for i in _rising([p for _, p in anchors])]
        pairs += cut
        edges = [(a - 1, c - 1), *cut, (b, d)]
        regions += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


def line_changes(old: str | None, new: str | None) -> list[dict]:
    """Removed, added and moved lines between two texts; a null text has no lines."""
    before = old.split("\n") if old is not None else []
    after = new.split("\n") if new is not None else []
    pairs = matched_lines(before, after)
    stay, come = {i for i, _ in pairs}, {j for _, j in pairs}
    waiting: dict[str, deque] = defaultdict(deque)
    for i, x in enumerate(before):
        if i not in stay:
            waiting[x].append(i)
    out = []
    for j, x in enumerate(after):
        if j not in come:
            from_ = waiting[x].popleft() if waiting.get(x) else None
            out.append({"op": "added" if from_ is None else "moved", "old_line": from_, "new_line": j, "line": x})
    out += [{"op": "removed", "old_line": i, "new_line": None, "line": x} for x, q in waiting.items() for i in q]
    return out


def apply_changes(old: str | None, changes) -> str | None:
    """The next version: lines that neither went nor moved keep their order
    around the added and moved ones. No lines at all are a null text."""
    before = old.split("\n") if old is not None else []
    gone = {c["old_line"] for c in changes if c["old_line"] is not None}
    placed = {c["new_line"]: c["line"] for c in changes if c["new_line"] is not None}
    kept = iter([x for i, x in enumerate(before) if i not in gone])
    total = len(before) - len(gone) + len(placed)
    lines = [placed[j] if j in placed else next(kept) for j in range(total)]
    return "\n".join(lines) if total else None


def compared(versions: DataFrame, key: str = "url", version: str = "version", text: str = "text") -> DataFrame:
    """(key, version, old, new, changes): every version (numbered from 1) but
    the last of its URL against the next one."""
    bounded_batches(versions.sparkSession)
    v = versions.select(key, F.col(version).alias("version"), F.col(text).alias("old"))
    following = versions.select(key, (F.col(version) - 1).alias("version"), F.col(text).alias("new"))

    @F.pandas_udf(T.ArrayType(CHANGE))
    def changes(old: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([line_changes(a, b) for a, b in zip(old, new, strict=True)], dtype=object)

    return v.join(following, [key, "version"]).withColumn("changes", changes("old", "new"))


@F.pandas_udf(T.StringType())
def applied(old: pd.Series, changes: pd.Series) -> pd.Series:
    """:func:`apply_changes` over Arrow batches."""
    return pd.Series([apply_changes(a, c) for a, c in zip(old, changes, strict=True)], dtype=object)


def audit(pairs: DataFrame, key: str = "url") -> DataFrame:
    """One row per changed line: op, old and new line number (from 0), line."""
    return pairs.select(key, "version", F.explode("changes").alias("c")).select(key, "version", "c.*")
