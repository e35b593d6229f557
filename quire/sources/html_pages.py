"""HTML page extractors.

Tables are read by regex in the JVM. Review blocks hang on element paths, so
a small Arrow-batched helper takes their raw parts out of each page's tree;
ids, statuses and item rows are column expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.arrays import bind
from quire.functions.markup import strip_tags
from quire.functions.text import comment_id, trim_ws
from quire.session import bounded_batches
from quire.sources import html_tree as ht

# Review page layout, as element paths. Blocks lie anywhere under
# main; headline: second text node of a span in the block's div/h3; text: the
# fourth paragraph of the block's div; id: the anchor in the sixth.
REVIEW_REGION = "main"
REVIEW_LABEL = {"aria-label": "Organisation review"}
TEXT_PARAGRAPH, ID_PARAGRAPH = 4, 6

_BLOCKS = T.ArrayType(T.StructType([T.StructField("headline", T.StringType()), T.StructField("html", T.StringType()),
                                    T.StructField("href", T.StringType())]))


def _children(parent: ht.Element, tag: str) -> list[ht.Element]:
    return [e for e in parent.elements() if e.tag == tag]


def _text_nodes(e: ht.Element) -> list[str]:
    return [c for c in e.children if isinstance(c, str) and not isinstance(c, ht.Comment)]


def _paragraph(block: ht.Element, place: int) -> ht.Element | None:
    return next((ps[place - 1] for d in _children(block, "div") if len(ps := _children(d, "p")) >= place), None)


def _review_parts(html: str | None) -> list[dict]:
    """Raw parts of every review block of a page, in document order."""
    found = []
    for main in ht.parse(html or "").find_all(REVIEW_REGION):
        if any(e.tag == REVIEW_REGION for e in ht.ancestors(main)):
            continue
        for block in main.find_all("div", **REVIEW_LABEL):
            spans = [s for d in _children(block, "div") for h in _children(d, "h3") for s in _children(h, "span")]
            heads = [t[1] for s in spans if len(t := _text_nodes(s)) > 1]
            text, last = _paragraph(block, TEXT_PARAGRAPH), _paragraph(block, ID_PARAGRAPH)
            anchor = next(iter(_children(last, "a")), None) if last is not None else None
            found.append({"headline": heads[0] if heads else None, "html": ht.outer_html(text) if text is not None else None,
                          "href": anchor.attrs.get("href") if anchor is not None else None})
    return found


@F.pandas_udf(_BLOCKS)
def _review_udf(pages: pd.Series) -> pd.Series:
    return pages.map(_review_parts)


def review_blocks(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """N6 + P14: every review block of a page becomes one html item:
    ``headline + '. ' + <4th paragraph markup>`` at ``page url + '#' + comment
    id``. The page is read as a tree, so attributes, nesting and further
    elements do not matter. Blocks without a headline, text or comment id get
    a reject ``status`` and no item; a blank headline counts as one."""
    bounded_batches(pages.sparkSession)
    ex = pages.select(id_col, url_col, F.posexplode(_review_udf(F.col(html_col))).alias("block_no", "b"))
    cid = comment_id(F.col("b.href"))
    status = (F.when(F.coalesce(F.col("b.headline"), F.lit("")) == "", F.lit("no headline"))
              .when(F.col("b.html").isNull(), F.lit("no text"))
              .when(cid == "", F.lit("no comment id")).otherwise(F.lit("ok")))
    ok = F.col("status") == "ok"
    return ex.withColumn("status", status).select(
        id_col, url_col, F.col("block_no").cast("long").alias("block_no"),
        F.when(ok, F.concat(F.col(url_col), F.lit("#"), cid)).alias("source_url"),
        F.when(ok, F.concat(trim_ws(F.col("b.headline")), F.lit(". "), F.col("b.html"))).alias("html"), "status")


def extract_table(html: Column, headers: list[str]) -> Column:
    """Rows of the first-level ``<tr>``s as structs named by
    ``headers`` (cell text = all descendant text, trimmed); null when the
    table has no rows."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)

    def row(r):
        cells = F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1)
        return F.struct(*[trim_ws(strip_tags(F.try_element_at(cells, F.lit(i + 1)))).alias(h)
                          for i, h in enumerate(headers)])

    return bind(rows, lambda rs: F.when(F.size(rs) > 0, F.transform(rs, row)))
