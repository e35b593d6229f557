"""Links of a page: anchors, URL resolution, allow-list, region limits
(N8, F7, P11, U8)."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind
from quire.functions.markup import decode_references, decode_references_sql

# Markup patterns. An anchor's href may be double-quoted,
# single-quoted or bare; it must be its own attribute (not data-href).
ANCHOR_TAG = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
HREF_VALUE = r"""(?is)=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))\z"""
ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
DOT_SEGMENT = r"(^|/)\.\.?(/|$)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag's markup; null without it."""
    pat = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return F.when(F.regexp_like(tag, F.lit(pat)), F.concat(*[F.regexp_extract(tag, pat, i) for i in (1, 2, 3)]))


def _has_class(tag: Column, cls: str | None) -> Column:
    return F.lit(True) if cls is None else F.coalesce(F.array_contains(F.split(_attribute(tag, "class"), r"\s+"), cls), F.lit(False))


def regions(html: Column | str, tag: str, cls: str | None = None) -> Column:
    """Balanced ``tag`` blocks (with class ``cls``), outermost first to last, as
    ``array<struct<inner, outer>>``.

    Opening and closing tags are counted from a block's own tag on, so blocks
    of the same tag may nest; tags in comments, scripts and styles do not
    count, and a block without an end goes to the end of the page."""
    pattern = rf"(?is)<!--.*?-->|<(?:script|style)(?=[\s/>]).*?</(?:script|style)\s*>|</?{tag}(?=[\s/>])[^>]*+>"
    h = F.coalesce(_c(html), F.lit(""))
    cut = F.struct(F.regexp_extract_all(h, F.lit(pattern), 0).alias("t"), F.split(h, pattern, -1).alias("p"))
    none = F.array().cast("array<struct<s:int,e:int>>")

    def steps(c):
        return F.transform(c["t"], lambda t, i: F.struct(
            i.alias("i"), F.regexp_like(t, F.lit(rf"(?is)^</?{tag}(?=[\s/>])")).alias("own"), t.startswith("</").alias("ends"),
            _has_class(t, cls).alias("fits")))

    def step(acc, x):
        d = acc["d"]
        deeper = (F.when(~x["own"], d).when(x["ends"], F.greatest(d - 1, F.lit(0)))
                  .when(d > 0, d + 1).when(x["fits"], F.lit(1)).otherwise(F.lit(0)))
        ended = (d > 0) & (deeper == 0)
        return F.struct(deeper.cast("int").alias("d"), F.when((d == 0) & (deeper == 1), x["i"]).otherwise(acc["s"]).cast("int").alias("s"),
                        F.when(ended, F.array_append(acc["out"], F.struct(acc["s"].alias("s"), x["i"].cast("int").alias("e")))).otherwise(acc["out"])
                        .cast("array<struct<s:int,e:int>>").alias("out"))

    def blocks(c):
        start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("s"), none.alias("out"))
        ranges = F.aggregate(steps(c), start, step, lambda acc: F.when(
            acc["d"] > 0, F.array_append(acc["out"], F.struct(acc["s"].alias("s"), F.size(c["t"]).alias("e")))).otherwise(acc["out"]))

        def block(r):
            body = F.flatten(F.transform(F.slice(F.arrays_zip(c["t"].alias("t"), F.slice(c["p"], 2, F.size(c["t"])).alias("p")),
                                                 r["s"] + 2, r["e"] - r["s"] - 1), lambda x: F.array(x["t"], x["p"])))
            inner = F.concat(F.element_at(c["p"], r["s"] + 2), F.array_join(body, ""))
            return F.struct(inner.alias("inner"), F.concat(F.element_at(c["t"], r["s"] + 1), inner,
                                                           F.coalesce(F.try_element_at(c["t"], r["e"] + 1), F.lit(""))).alias("outer"))

        return F.transform(ranges, block)

    return bind(cut, blocks)


def region(html: Column | str, tag: str, cls: str | None = None) -> Column:
    """Markup inside every balanced ``tag`` block, joined (restrict_css)."""
    return F.array_join(F.transform(regions(html, tag, cls), lambda r: r["inner"]), "")


def link_with_class(html: Column | str, cls: str) -> Column:
    """The href of the page's first anchor with a class."""
    tags = F.filter(F.regexp_extract_all(F.coalesce(_c(html), F.lit("")), F.lit(r"(?is)<a(?=\s)[^>]*+>"), 0), lambda t: _has_class(t, cls))
    return decode_references(_attribute(F.try_element_at(tags, F.lit(1)), "href"))


def anchors(html: Column | str) -> Column:
    """Hrefs of all anchors in document order (character references in
    the value decoded, as a parser does)."""
    def value(m):
        return decode_references(F.concat(*[F.regexp_extract(m, HREF_VALUE, i) for i in (1, 2, 3)]))
    return F.transform(F.regexp_extract_all(_c(html), F.lit(ANCHOR_TAG), 0), value)


def anchors_sql(expr: str) -> str:
    """DuckDB SQL of :func:`anchors` (oracle side)."""
    tag = ANCHOR_TAG.replace("'", "''")
    val = HREF_VALUE.replace("'", "''")
    parts = " || ".join(f"regexp_extract(m, '{val}', {i})" for i in (1, 2, 3))
    return f"list_transform(regexp_extract_all({expr}, '{tag}', 0), lambda m: {decode_references_sql(parts)})"


def _dot_resolve(b: Column, h: Column, origin: Column, no_query: Column) -> Column:
    """Merge a relative path into the base path and remove dot segments with
    a stack (an ``aggregate`` fold over the path segments)."""
    bpath = F.regexp_extract(no_query, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)?$", 1)
    hpath = F.regexp_extract(h, r"^([^?#]*)", 1)
    tail = F.substring(h, F.length(hpath) + 1, F.lit(1 << 30))
    bparts = F.split(bpath, "/", -1)
    bparts = F.when(F.element_at(bparts, -1) != "", F.slice(bparts, 1, F.size(bparts) - 1)).otherwise(bparts)
    raw = F.when(hpath.startswith("/"), F.split(hpath, "/", -1)).otherwise(
        F.concat(bparts, F.split(hpath, "/", -1)))

    def merged(sg):
        n = F.size(sg)
        mid = F.filter(F.slice(sg, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != "")
        # empty middle segments are dropped only when merging with the base path
        return F.when((n <= 2) | hpath.startswith("/"), sg).otherwise(
            F.concat(F.slice(sg, 1, 1), mid, F.slice(sg, n, 1)))

    def push(acc, seg):
        pop = F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        return F.when(seg == "..", pop).when(seg == ".", acc).otherwise(F.array_append(acc, seg))

    def resolve(sg):
        stack = F.aggregate(sg, F.array().cast("array<string>"), push)
        stack = F.when(F.element_at(sg, -1).isin(".", ".."), F.array_append(stack, F.lit(""))).otherwise(stack)
        return F.array_join(stack, "/")

    path = bind(bind(bind(raw, merged), resolve), lambda p: F.when(p == "", F.lit("/"))
                .when(~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p))
    return F.concat(origin, path, tail)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """``urljoin(base, href)`` as a native expression - absolute,
    protocol-relative, root-relative, query, fragment, same-folder and
    dot-segment hrefs."""
    b, h0 = _c(base), _c(href)
    # "//" followed by a path, query or fragment has an empty authority: the
    # rest is resolved like a plain href
    h = F.when(h0.rlike(r"^//[/?#]"), F.substring(h0, 3, 1 << 30)).otherwise(h0)
    origin = F.regexp_extract(b, ORIGIN, 1)
    scheme = F.regexp_extract(b, SCHEME, 1)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path_dir = F.regexp_extract(no_query, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/.*)?/)", 1)
    folder = F.when(path_dir == "", F.concat(origin, F.lit("/"))).otherwise(path_dir)
    return (F.when(h0.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h0)
            .when(h0.rlike(r"^//[^/?#]"), F.concat(scheme, F.lit(":"), h0))
            .when(h0 == "//", no_frag)
            .when(h == "", b)
            .when(h.startswith("?"), F.concat(no_query, h))
            .when(h.startswith("#"), F.concat(no_frag, h))
            .when(h.rlike(DOT_SEGMENT) | (~h.startswith("/") & h.contains("//")),
                  _dot_resolve(b, h, origin, no_query))
            .when(h.startswith("/"), F.concat(origin, h))
            .otherwise(F.concat(folder, h)))


@F.pandas_udf(T.StringType())
def urljoin_exact(base: pd.Series, href: pd.Series) -> pd.Series:
    """The standard library's ``urljoin`` over Arrow batches (reference form)."""
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href)])


def resolve_links(df: DataFrame, base: str, href: str, out: str = "abs_url") -> DataFrame:
    """F7 over a frame of (base, href) pairs."""
    return df.withColumn(out, resolve_url(base, href))


def page_links(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", region_tag: str | None = None) -> DataFrame:
    """N8 + F7: one row per anchor ``(page, pos, href, abs_url)``."""
    src = F.col(html_col) if region_tag is None else region(html_col, region_tag)
    ex = pages.select(id_col, url_col, F.posexplode(anchors(src)).alias("pos", "href"))
    ex = ex.withColumn("pos", F.col("pos").cast("long"))
    return resolve_links(ex, url_col, "href")


def allowed(links: DataFrame, allow: str, url_col: str = "abs_url") -> DataFrame:
    """Keep links whose absolute URL matches the allow pattern."""
    return links.where(F.col(url_col).rlike(allow))


def first_seen(links: DataFrame, url_col: str = "abs_url",
               order: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """U8: one row per URL - where it was first seen and how often it occurs.
    A ``min_by``/``count`` aggregate, combined map-side before the shuffle."""
    first = F.min(F.struct(*order))
    return (links.groupBy(F.col(url_col).alias("url"))
            .agg(first.alias("_f"), F.count(F.lit(1)).alias("n_refs"))
            .select("url", *[F.col(f"_f.{c}").alias(c) for c in order], "n_refs"))


def resolve_url_sql(b: str, h: str) -> str:
    """DuckDB SQL of :func:`resolve_url` (oracle side)."""
    origin = f"regexp_extract({b}, '{ORIGIN}', 1)"
    scheme = f"regexp_extract({b}, '{SCHEME}', 1)"
    no_frag = f"regexp_replace({b}, '#.*$', '')"
    no_query = f"regexp_replace({no_frag}, '\\?.*$', '')"
    path_dir = f"regexp_extract({no_query}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/.*)?/)', 1)"
    folder = f"(CASE WHEN {path_dir} = '' THEN {origin} || '/' ELSE {path_dir} END)"
    return (f"CASE WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"WHEN {h} = '' THEN {b} "
            f"WHEN starts_with({h}, '?') THEN {no_query} || {h} "
            f"WHEN starts_with({h}, '#') THEN {no_frag} || {h} "
            f"ELSE {folder} || {h} END")
