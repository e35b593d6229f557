"""String, id, JSON and naming expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id patterns of the dictionary source.
# Item page href -> id (the dot before "html" is a regex wildcard on purpose).
ITEM_ID_PATTERN = r"(?:^|/)([^/]+).html$"
# Index page href patterns per item type; the data-set index keys on "#".
INDEX_ID_PATTERNS = {
    "element": r"data_elements/([^/]+).html$",
    "attribute": r"attributes/([^/]+).html$",
    "class": r"classes/([^/]+).html$",
    "businessDefinition": r"nhs_business_definitions/([^/]+).html$",
    "dataSet": r"/([^/]+).html#",
}
# Item type -> the spelling used inside article ids.
TYPE_IN_ID = {
    "element": "element",
    "attribute": "attribute",
    "class": "class",
    "businessDefinition": "business_definition",
    "dataSet": "dataset",
}
# Link classes in precedence order (first hit wins).
LINK_CLASSES = ["element", "attribute", "class", "businessDefinition", "dataSet"]
# Review comment id in a report link: word characters (Unicode letters,
# digits, '_') and '-', spelled out so Java and RE2 read it alike.
COMMENT_ID_PATTERN = r"report\?commentID=([\p{L}\p{N}_-]+)"
# Document name keeps the last 150 characters of the URL.
DOC_NAME_CHARS = 150
# Retry delay when Retry-After is missing or not an integer (seconds).
DEFAULT_RETRY_SECONDS = 30
# Whitespace as Python's str.strip() sees it (ASCII, separators, NEL, NBSP,
# information separators), spelled out so Java and RE2 read it alike.
WHITESPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
TRIM_PATTERN = f"^{WHITESPACE}+|{WHITESPACE}+$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract_item_id(href: Column | str) -> Column:
    """id from an item href, '' when the href does not match."""
    return F.regexp_extract(_c(href), ITEM_ID_PATTERN, 1)


def index_item_id(href: Column | str, item_type: Column | str) -> Column:
    """id from an index href using the pattern of ``item_type`` ('' if none)."""
    h, t = _c(href), _c(item_type)
    out = F.lit("")
    for typ, pat in INDEX_ID_PATTERNS.items():
        out = F.when(t == typ, F.regexp_extract(h, pat, 1)).otherwise(out)
    return out


def type_in_id(item_type: Column | str) -> Column:
    """source-specific alias of an item type inside element ids."""
    t = _c(item_type)
    m = F.create_map(*[x for kv in TYPE_IN_ID.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(m[t], t)


def comment_id(href: Column | str) -> Column:
    """review comment id ('' when absent)."""
    return F.regexp_extract(F.coalesce(_c(href), F.lit("")), COMMENT_ID_PATTERN, 1)


def trim_ws(x: Column | str) -> Column:
    """strip leading/trailing whitespace of any kind (``trim`` strips spaces only)."""
    return F.regexp_replace(_c(x), TRIM_PATTERN, "")


def doc_name(url: Column | str) -> Column:
    """Last 150 characters of the URL."""
    return F.right(_c(url), F.lit(DOC_NAME_CHARS))


def doc_meta_json(source_id: Column | str, source_url: Column | str) -> Column:
    """stored document meta ``{"source_id":..,"source_url":..}``, both keys always."""
    return F.to_json(F.struct(_c(source_id).alias("source_id"), _c(source_url).alias("source_url")), {"ignoreNullFields": "false"})


def content_key(url: Column | str, text: Column | str) -> Column:
    """Identity for sources without ids: url + '#' + md5(text)."""
    return F.concat(_c(url), F.lit("#"), F.md5(_c(text)))


def retry_seconds(retry_after: Column | str) -> Column:
    """integer Retry-After, else 30."""
    return F.coalesce(F.expr(f"try_cast({retry_after} AS INT)") if isinstance(retry_after, str)
                      else retry_after.try_cast("int"), F.lit(DEFAULT_RETRY_SECONDS))


def drop_class(attrs: Column | str) -> Column:
    """remove the ``class`` key of an attribute map."""
    return F.map_filter(_c(attrs), lambda k, v: k != F.lit("class"))


def export_file_name(source_id: Column | str, ts: Column | str, text: Column | str) -> Column:
    """``{source_id}_{yyyyMMddHHmmss}_{stable hash}`` (no random part)."""
    return F.concat_ws(
        "_", _c(source_id), F.date_format(_c(ts), "yyyyMMddHHmmss"),
        F.substring(F.sha1(F.coalesce(_c(text), F.lit(""))), 1, 12))


def link_type(is_key: Column | str) -> Column:
    """class attribute link type from the key flag."""
    return F.when(_c(is_key), F.lit("key_attribute")).otherwise(F.lit("attribute"))


def nonblank(x: Column | str) -> Column:
    """own text node non-blank."""
    return trim_ws(F.coalesce(_c(x), F.lit(""))) != ""
