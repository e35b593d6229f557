"""Rule annotator spans.

``rule_spans(text, pattern)`` returns ``ARRAY<STRUCT<start_offset, end_offset,
label, prob>>`` for every match of ``pattern``: the span is the whole match,
the label its first group, offsets count code points. It is a native
expression - the text never leaves the JVM:

* ``split(text, pattern, -1)`` gives the k+1 pieces between the k matches,
* ``regexp_extract_all`` gives the k matches (group 0) and labels (group 1),
* offsets are prefix sums of piece and match lengths, computed in
  O(k^1.5) per text with block sums (linear in the corpus).

The pattern must not match the empty string. ``skip_one=True`` (leave a
character between two spans) and arbitrary Python annotators use
:func:`python_spans` instead.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind
from quire.schemas import SPAN

# The shipped annotator's pattern and probability.
DEFAULT_PATTERN = r"\b(testing)\b"
DEFAULT_PROB = 0.8


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


_bind = bind


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0).cast("long"), lambda a, x: a + x)


def exclusive_prefix(steps: Column) -> Column:
    """Exclusive prefix sums of a ``bigint`` array in O(k^1.5): sums of
    sqrt(k)-sized blocks, prefix over the blocks, then a short in-block sum
    per element (Spark SQL has no scan over arrays; a fold that appends
    would copy the array k times)."""
    def with_steps(st):
        k = F.size(st)
        b = F.greatest(F.lit(1), F.ceil(F.sqrt(k)).cast("int"))
        nb = F.ceil(k / b).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), nb - 1), lambda j: _sum(F.slice(st, j * b + 1, b)))
        zero = F.lit(0).cast("long")
        before = F.aggregate(
            blocks, F.struct(zero.alias("s"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.array_append(acc["out"], acc["s"]).alias("out")),
            lambda acc: acc["out"])

        def with_before(bf):
            def at(i):
                blk = F.floor(i / b).cast("int")
                return F.element_at(bf, blk + 1) + _sum(F.slice(st, blk * b + 1, i - blk * b))
            return F.transform(F.sequence(F.lit(0), k - 1), at)

        return F.when(k > 0, _bind(before, with_before)).otherwise(F.array().cast("array<bigint>"))

    return _bind(steps, with_steps)


def rule_spans(text: Column | str, pattern: str = DEFAULT_PATTERN,
               prob: float = DEFAULT_PROB, group: int = 1) -> Column:
    t = _c(text)
    empty = F.array().cast(T.ArrayType(SPAN))

    def spans(r):
        gaps = F.transform(F.slice(r["pieces"], 1, F.size(r["whole"])), lambda g: F.length(g).cast("long"))
        lens = F.transform(r["whole"], lambda m: F.length(m).cast("long"))

        def with_lengths(gl):
            # start_i = sum over j < i of (gap_j + match_j) + gap_i
            before = exclusive_prefix(F.zip_with(gl["g"], gl["l"], lambda g, m: g + m))
            return F.transform(
                F.arrays_zip(before.alias("p"), gl["g"].alias("g"), gl["l"].alias("l"), r["labels"].alias("label")),
                lambda x: F.struct((x["p"] + x["g"]).alias("start_offset"),
                                   (x["p"] + x["g"] + x["l"]).alias("end_offset"),
                                   x["label"].alias("label"), F.lit(prob).cast("double").alias("prob")))

        return _bind(F.struct(gaps.alias("g"), lens.alias("l")), with_lengths)

    def with_matches(whole):
        # texts without a match (most of a corpus) skip the other two passes
        found = F.struct(F.split(t, pattern, -1).alias("pieces"), whole.alias("whole"),
                         F.regexp_extract_all(t, F.lit(pattern), group).alias("labels"))
        return F.when(F.size(whole) == 0, empty).otherwise(_bind(found, spans).cast(T.ArrayType(SPAN)))

    return F.when(t.isNotNull(), _bind(F.regexp_extract_all(t, F.lit(pattern), 0), with_matches))


def rule_spans_sql(text: str, pattern: str = DEFAULT_PATTERN, prob: float = DEFAULT_PROB) -> str:
    """DuckDB SQL of :func:`rule_spans` (oracle side; quadratic, small inputs)."""
    pieces = f"regexp_split_to_array({text}, '{pattern}')"
    whole = f"regexp_extract_all({text}, '{pattern}', 0)"
    labels = f"regexp_extract_all({text}, '{pattern}', 1)"
    start = (f"(coalesce(list_sum(list_transform({pieces}[1:i + 1], lambda p: length(p))), 0) + "
             f"coalesce(list_sum(list_transform({whole}[1:i], lambda w: length(w))), 0))")
    return (f"list_transform(range(len({whole})), lambda i: {{'start_offset': CAST({start} AS BIGINT), "
            f"'end_offset': CAST({start} + length({whole}[i + 1]) AS BIGINT), "
            f"'label': {labels}[i + 1], 'prob': CAST({prob} AS DOUBLE)}})")


def _span(match: re.Match, group: int, prob: float) -> dict:
    return {"start_offset": match.start(), "end_offset": match.end(), "label": match.group(group), "prob": prob}


def find_spans(text: str | None, pattern: str = DEFAULT_PATTERN, prob: float = DEFAULT_PROB, group: int = 1):
    """The rule annotator over one text: all matches, left to right."""
    return None if text is None else [_span(m, group, prob) for m in re.finditer(pattern, text)]


def find_spans_apart(text: str | None, pattern: str = DEFAULT_PATTERN, prob: float = DEFAULT_PROB, group: int = 1):
    """The same with at least one character between two spans: the scanner
    of a compiled pattern is restarted one character behind each match."""
    if text is None:
        return None
    rx = re.compile(pattern)
    first = rx.search(text)
    chain = [first] if first else []
    while chain and (m := rx.search(text, chain[-1].end() + 1)):
        chain.append(m)
    return [_span(m, group, prob) for m in chain]


def python_spans(annotator=None, skip_one: bool = False, **kw):
    """X3 plug-in: wrap a Python ``annotate(text) -> [span dict]`` (default:
    :func:`find_spans`, or :func:`find_spans_apart` with ``skip_one``, with
    ``kw``) as an Arrow-batched pandas UDF."""
    rule = find_spans_apart if skip_one else find_spans
    fn = annotator or (lambda s: rule(s, **kw))

    @F.pandas_udf(T.ArrayType(SPAN))
    def _spans(texts: pd.Series) -> pd.Series:
        return texts.map(fn)

    return _spans


class _SpanRows:
    """The rule annotator as a table function: one row per match."""

    def eval(self, text: str, pattern: str):
        for m in re.finditer(pattern or DEFAULT_PATTERN, text or ""):
            yield m.start(), m.end(), m.group(1), DEFAULT_PROB


def register_annotator(spark: SparkSession, name: str = "span_rows", annotator: type = _SpanRows) -> None:
    """X3 in SQL: an annotator class (``eval(text, pattern)`` yields start,
    end, label and probability) as an Arrow table function, to be called as
    ``FROM documents d, LATERAL span_rows(d.text, pattern) s``."""
    spark.udtf.register(name, F.udtf(annotator, returnType="start_offset bigint, end_offset bigint, label string, prob double",
                                     useArrow=True))
