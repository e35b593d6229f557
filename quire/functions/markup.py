"""Markup to plain text (F1).

Two forms of the same rule "concatenate every text run, decode character
references, keep script/style bodies, drop tags and comments without
inserting a space":

* :func:`strip_tags` - a native expression (JVM side, whole-stage codegen
  friendly): tokenise the markup with one regex, map each token, join.
* :func:`strip_tags_exact` - an Arrow-batched pandas UDF over the standard
  library ``html.parser``; the tests' yardstick for the native form.

The native form follows the parser fed once and never closed: quoted
attribute values may hold '>', unclosed comments/tags/script bodies and a
trailing lone '<' swallow the rest, and a final run with a pending '&' is
held back. Tests compare both forms on every page and on fuzzed markup.
"""

from __future__ import annotations

import json
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind

# Token grammar, first match wins: script and style elements (closed, or
# running to the end of input), comments (closed or not), declarations and
# processing instructions, start tags (a value quoted right after '=' may
# hold '>'; every character has one reading, so a cut-off tag never makes the
# matcher backtrack), end tags (up to the first '>'), tags
# cut off by the end of input, bogus end tags, text runs, a lone '<'.
# Attribute area of a start tag: runs without '=' or '>', and values. The
# repetition is possessive: every character has one reading, Java then loops
# instead of recursing, and tags of any length are read whole.
_ATTRS = r"""(?:[^>=]++|=++\s*+"[^"]*+"|=++\s*+'[^']*+'|=++\s*+[^>="'\s])*+"""
TOKEN_PATTERN = (
    r"(?is)<script(?:[\s/][^>]*)?>.*?</script\s*>|<style(?:[\s/][^>]*)?>.*?</style\s*>"
    r"|<script(?:[\s/][^>]*)?>.*\z|<style(?:[\s/][^>]*)?>.*\z"
    r"|<!--.*?-->|<!--.*\z|<![^>]*>|<![^>]*\z|<\?[^>]*>|<\?[^>]*\z"
    r"|<[a-z][^\s/>]*+" + _ATTRS + r"(?:=+\s*)?>"
    r"|<[a-z][^\s/>]*+" + _ATTRS + r"""(?:=+\s*(?:"[^"]*|'[^']*)?)?\z"""
    r"|<[a-z][^>]*>|<[a-z][^>]*\z"
    r"|</[a-z][^>]*>|</[^>]*>|</[^>]*\z"
    r"|[^<]+|<"
)
# RE2 (DuckDB) never backtracks and has no possessive form.
RE2_TOKEN_PATTERN = TOKEN_PATTERN.replace("++", "+").replace("*+", "*")
# A parser fed once and never closed holds back, at the end of input, a lone
# '<' and a final text run whose last '&' (within 34 characters of the end)
# is not followed by whitespace or ';' - both never reach the text.
PENDING_REFERENCE = r"&[^\s;&]{0,33}\z"
SCRIPT_BODY = r"(?is)^<script[^>]*>(.*)</script\s*>$"
STYLE_BODY = r"(?is)^<style[^>]*>(.*)</style\s*>$"

# The references met most, decoded without a table lookup.
NAMED_REFERENCES = [
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
# One reference as the parser sees it, and text cut at references.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REFERENCE_PIECES = REFERENCE + r"|[^&]+|&"
# Names that stand without ';': the longest one a reference starts with counts.
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Numeric references to 128..159 mean windows-1252 where that has a character.
_WINDOWS_1252 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]


def _numeric_reference(body: Column) -> Column:
    """Character of ``#123`` / ``#x1F`` (a ``;`` may follow); '' for code
    points the parser drops, U+FFFD for impossible ones."""
    hexadecimal = F.lower(F.substring(body, 2, 1)) == "x"
    digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
    value = F.coalesce(F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long"), F.lit(0))
    value = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(value)

    def char(n):
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        dropped = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
                   | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
        return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
                .when(n.between(128, 159), F.get(F.array(*[F.lit(c) for c in _WINDOWS_1252]), (n - 128).cast("int")))
                .when(dropped, F.lit("")).otherwise(plain))

    return bind(value, char)


def _named_reference(ref: Column) -> Column:
    """A named reference; unknown names stay as they are."""
    # a constant map of the standard's names, folded once by the optimizer
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    body = F.substr(ref, F.lit(2))
    whole = F.try_element_at(names, body)
    bare = F.regexp_extract(body, "^(?:" + "|".join(_BARE_NAMES) + ")", 0)
    return F.coalesce(whole, bind(bare, lambda n: F.when(n != "", F.concat(
        F.try_element_at(names, n), F.substr(body, F.length(n) + 1))).otherwise(ref)))


def decode_references(c: Column) -> Column:
    """Every character reference of the HTML standard, as the parser decodes it."""
    def one(piece):
        out = F.when(~piece.startswith("&") | (piece == "&"), piece)
        for ref, ch in NAMED_REFERENCES:
            out = out.when(piece == ref, F.lit(ch))
        return (out.when(piece.startswith("&#"), _numeric_reference(F.substr(piece, F.lit(2))))
                .otherwise(_named_reference(piece)))

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(REFERENCE_PIECES), 0), one), "")


def decode_references_sql(expr: str) -> str:
    """DuckDB SQL for text that holds none but ``NAMED_REFERENCES`` (the driver's pages)."""
    out = f"({expr})"
    for ref, ch in NAMED_REFERENCES:
        lit = ch.replace("'", "''")
        out = f"replace({out}, '{ref}', '{lit}')"
    return out


def _token_text(t: Column) -> Column:
    # cheapest tests first: most tokens are text runs without references
    low = F.lower(F.substring(t, 1, 7))
    return (
        F.when(~t.startswith("<"), F.when(t.contains("&"), decode_references(t)).otherwise(t))
        .when(t == "<", t)
        .when(low.startswith("<script"), F.regexp_extract(t, SCRIPT_BODY, 1))
        .when(low.startswith("<style"), F.regexp_extract(t, STYLE_BODY, 1))
        .otherwise(F.lit(""))
    )


def _drop_pending_tail(tokens: Column) -> Column:
    n = F.size(tokens)
    last = F.element_at(tokens, -1)
    pending = (last == "<") | (~last.startswith("<") & last.rlike(PENDING_REFERENCE))
    return F.when((n > 0) & pending, F.slice(tokens, 1, n - 1)).otherwise(tokens)


def strip_tags(html: Column | str) -> Column:
    """Native markup stripping; null in, null out."""
    h = F.col(html) if isinstance(html, str) else html
    tokens = F.regexp_extract_all(h, F.lit(TOKEN_PATTERN), 0)
    # the token array is used several times: tokenise once
    text = bind(tokens, lambda t: F.array_join(F.transform(_drop_pending_tail(t), _token_text), ""))
    return F.when(h.isNotNull(), text)


def strip_tags_sql(expr: str) -> str:
    """The same rule as DuckDB SQL text (used by the oracle queries)."""
    dec = decode_references_sql("t")
    pat = RE2_TOKEN_PATTERN.replace("'", "''")
    toks = f"regexp_extract_all({expr}, '{pat}', 0)"
    kept = (f"(CASE WHEN len({toks}) > 0 AND ({toks}[-1] = '<' OR (NOT starts_with({toks}[-1], '<') "
            f"AND regexp_matches({toks}[-1], '{PENDING_REFERENCE}'))) THEN {toks}[1:len({toks}) - 1] ELSE {toks} END)")
    return (
        f"array_to_string(list_transform({kept}, "
        f"lambda t: CASE WHEN starts_with(lower(t[1:7]), '<script') "
        f"THEN regexp_extract(t, '{SCRIPT_BODY}', 1) "
        f"WHEN starts_with(lower(t[1:7]), '<style') THEN regexp_extract(t, '{STYLE_BODY}', 1) "
        f"WHEN t = '<' THEN t WHEN starts_with(t, '<') THEN '' ELSE {dec} END), '')"
    )


def _strip_one(html):
    from html.parser import HTMLParser

    if html is None:
        return None
    parts: list[str] = []

    class _Collector(HTMLParser):
        def handle_data(self, data):
            parts.append(data)

    p = _Collector(convert_charrefs=True)
    p.feed(html)  # no close(): an unfinished trailing run is not flushed
    return "".join(parts)


@F.pandas_udf(T.StringType())
def strip_tags_exact(html: pd.Series) -> pd.Series:
    """Parser-exact stripping (Arrow batches, one parser per value)."""
    return html.map(_strip_one)
