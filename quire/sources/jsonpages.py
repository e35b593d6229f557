"""JSON pages: index pages with result links, article pages with nested
markdown (S2, S3, P6, P9, P10, P19, N1, F8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind
from quire.functions.dates import parse_iso

INDEX_SCHEMA = T.StructType([
    T.StructField("relatedLink", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]))),
    T.StructField("significantLink", T.ArrayType(T.StructType([
        T.StructField("linkRelationship", T.StringType()), T.StructField("url", T.StringType())]))),
])

# Link names in index pages.
RESULT = "Result"
NEXT_PAGE = "Next Page"
MARKDOWN = "markdown"


def parse_index(pages: DataFrame, body: str = "body", keys: list[str] | None = None) -> DataFrame:
    """Requests from index pages.

    Result links become ``kind='item'`` rows with ``position`` (0-based in
    list order) and ``priority = -position``; a page without result links
    requests its first "Next Page" (``kind='index'``). Pages with results
    carry ``next_page`` for after their items are released (W2).
    """
    keys = keys or []
    j = pages.select(*keys, F.from_json(body, INDEX_SCHEMA).alias("j"))
    results = F.filter("j.significantLink", lambda x: x["linkRelationship"] == RESULT)
    nxt = F.try_element_at(F.filter("j.relatedLink", lambda x: x["name"] == NEXT_PAGE), F.lit(1))["url"]
    j = j.select(*keys, results.alias("results"), nxt.alias("next_page"))
    items = (j.select(*keys, "next_page", F.posexplode("results").alias("position", "r"))
             .select(*keys, F.lit("item").alias("kind"), F.col("position").cast("long").alias("position"),
                     F.col("r.url").alias("url"), (-F.col("position")).cast("long").alias("priority"),
                     "next_page"))
    index = (j.where((F.size("results") == 0) & F.col("next_page").isNotNull())
             .select(*keys, F.lit("index").alias("kind"), F.lit(None).cast("long").alias("position"),
                     F.col("next_page").alias("url"), F.lit(0).cast("long").alias("priority"),
                     F.lit(None).cast("string").alias("next_page")))
    return items.unionByName(index)


NESTED = '"mainEntityOfPage"'
_NODES = "array<struct<path:array<int>,node:variant>>"
_TEXTS = "array<struct<path:array<int>,text:string>>"


def markdown_text(body: Column | str) -> Column:
    """Text of all ``markdown`` nodes of an article body, any depth: own
    text before children, descending into lists only. A body that is no JSON
    is null, one without nodes is empty.

    The body is read once as VARIANT. A fold expands the nodes level by level,
    as often as the key of nested nodes occurs in the body, and carries each
    node's path; texts are joined in path order, which is depth-first."""
    b = F.col(body) if isinstance(body, str) else body

    def children(node):
        return F.coalesce(F.try_variant_get(node, "$.mainEntityOfPage", "array<variant>"), F.array().cast("array<variant>"))

    def below(nodes):
        return F.flatten(F.transform(nodes, lambda x: F.transform(
            children(x["node"]), lambda k, i: F.struct(F.array_append(x["path"], i).alias("path"), k.alias("node"))))).cast(_NODES)

    def texts(nodes):
        marked = F.filter(nodes, lambda x: F.coalesce(F.try_variant_get(x["node"], "$.name", "string") == MARKDOWN, F.lit(False)))
        return F.transform(marked, lambda x: F.struct(
            x["path"].alias("path"), F.coalesce(F.try_variant_get(x["node"], "$.text", "string"), F.lit("")).alias("text"))).cast(_TEXTS)

    def level(acc, _):
        return bind(below(acc["nodes"]), lambda ns: F.struct(ns.alias("nodes"), F.concat(acc["texts"], texts(ns)).cast(_TEXTS).alias("texts")))

    def walked(root):
        start = F.struct(F.array(F.struct(F.array().cast("array<int>").alias("path"), root.alias("node"))).cast(_NODES).alias("nodes"),
                         F.array().cast(_TEXTS).alias("texts"))
        levels = F.sequence(F.lit(0), F.regexp_count(b, F.lit(NESTED)).cast("int"))
        return F.aggregate(levels, start, level, lambda acc: F.array_join(F.transform(F.array_sort(acc["texts"]), lambda x: x["text"]), ""))

    return bind(F.try_parse_json(b), lambda v: F.when(v.isNotNull(), walked(v)))


def parse_article(responses: DataFrame, body: str = "body", status: str = "status") -> DataFrame:
    """Article responses to html items. Non-200 responses give an
    empty item (it still fills its position); ``dateModified`` is parsed."""
    ok = F.col(status) == 200
    return (responses
            .withColumn("html", F.when(ok, markdown_text(F.col(body))).otherwise(F.lit("")))
            .withColumn("modified_at", F.when(ok, parse_iso(F.get_json_object(body, "$.dateModified")))))


def drop_empty(items: DataFrame, col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(items with text, rejects for the empty ones)."""
    empty = F.col(col).isNull() | (F.col(col) == "")
    return items.where(~empty), items.where(empty)
