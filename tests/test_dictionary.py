"""X4/N2/N3/A5 dictionary pages (fixture F8), index pages (P12, N5) and
the dictionary/link stores (U2, U3, J6, J7; fixture F9)."""

from pyspark.sql import functions as F

from quire.operators import dictionary as dct
from quire.sources import dictionary_pages as dp

BASE = "https://dict.example.org/"


def page(typ, tin, iid, body="", head='<meta name="name" content="Name X">'):
    sec = "overview" if typ == "dataSet" else "description"
    return (f"<html><head>{head}</head><body><div id=\"wh_topic_body\">"
            f'<article id="{tin}_{iid}.{sec}"><div class="body"><div class="d">Intro '
            f'<a class="element" href="../data_elements/e1.html">e1</a> and '
            f'<a class="x element" href="../data_elements/e1.html">again</a>, '
            f'<a class="{typ}" href="{iid}.html">self</a>, '
            f'<a class="attribute" href="../attributes/a9.htm">not html</a>, '
            f'<a href="/other/page">ext</a><script>bad()</script>dropped tail <b class="k">bold</b>'
            f"</div></div></article>{body}</div></body></html>")


def items(spark, rows):
    df = spark.createDataFrame(rows, "source_url string, last_modified string, item_type string, item_id string, html string")
    return {r.item_type: r for r in dp.extract_items(df).collect()}


def test_item_pages(spark):
    cls_body = ('<article id="class_c1.attributes"><div class="body"><table><tbody>'
                '<tr><td>Key</td><td><a href="../attributes/k1.html">k</a></td></tr>'
                '<tr><td> </td><td><a href="../attributes/n1.html">n</a></td></tr></tbody></table></div></article>')
    el_body = ('<article id="element_el1.attribute"><div class="body"><a class="attribute" '
               'href="../attributes/at1.html">a</a></div></article>'
               '<article id="element_el1.also_known_as"><div class="body"><table><tbody>'
               '<tr><td> ctx </td><td>alias1</td></tr></tbody></table></div></article>'
               '<article id="element_el1.format___length"><div class="body"><p> max 10 </p></div></article>')
    ds_body = ('<article id="dataset_ds1.specification"><div class="body"><p>spec '
               '<a class="dataSet" href="ds2.html">d</a></p></div></article>')
    rows = [
        (BASE + "el1.html", "Wed, 21 Oct 2015 07:28:00 GMT", "element", "el1", page("element", "element", "el1", el_body)),
        (BASE + "at1.html", None, "attribute", "at1", page("attribute", "attribute", "at1")),
        (BASE + "c1.html", None, "class", "c1", page("class", "class", "c1", cls_body)),
        (BASE + "b1.html", None, "businessDefinition", "b1", page("businessDefinition", "business_definition", "b1")),
        (BASE + "ds1.html", None, "dataSet", "ds1", page("dataSet", "dataset", "ds1", ds_body)),
    ]
    got = items(spark, rows)
    assert {r.status for r in got.values()} == {"ok"}
    desc_link = ("element", "e1", None)
    lk = lambda r: [(x.item_type, x.item_id, x.link_type) for x in r.links]
    assert lk(got["attribute"]) == [desc_link]  # duplicate kept once, self and non-html excluded
    assert lk(got["element"]) == [desc_link, ("attribute", "at1", "element_attribute")]
    assert lk(got["class"]) == [desc_link, ("attribute", "k1", "key_attribute"), ("attribute", "n1", "attribute")]
    assert lk(got["dataSet"]) == [desc_link, ("dataSet", "ds2", None)]
    el = got["element"]
    assert el.name == "Name X" and el.modified_at is not None and got["class"].modified_at is None
    assert el.meta.format == "max 10"
    assert [(a.context, a.alias) for a in el.meta.aliases] == [("ctx", "alias1")]
    assert got["attribute"].meta is None  # no extra tables -> null meta
    assert got["dataSet"].meta.ds_spec.startswith("<article><p>spec <a data-item-type=\"dataSet\"")
    d = got["attribute"].description
    assert '<a data-item-type="element" data-item-id="e1">e1</a>' in d
    assert '<a href="https://dict.example.org/other/page">ext</a>' in d
    assert "bad()" not in d and "dropped tail" not in d
    assert "<b>bold</b>" in d and "class=" not in d


def test_page_without_body_is_rejected(spark):
    rows = [(BASE + "z.html", None, "element", "z", "<html><body><p>nothing</p></body></html>")]
    assert items(spark, rows)["element"].status == "no topic body"


def test_index_pages_and_dataset_tree(spark):
    el_index = ('<html><body><article id="dataElement_overview"><article>'
                '<a class="element" href="data_elements/e1.html">e1</a>'
                '<a class="element" href="data_elements/bad.htm">bad</a></article></article></body></html>')
    tree1 = ('<html><body><ul role="tree"><li><span data-state="leaf"><span class="title">'
             '<a href="/data_sets/ds1.html#x">ds1</a></span></span></li>'
             '<li><span data-state="not-ready"><span class="title"><a id="data_sets.sub" href="sub.html">s</a>'
             '</span></span></li><li><span data-state="not-ready"><span class="title">'
             '<a id="other" href="skip.html">o</a></span></span></li></ul></body></html>')
    tree2 = ('<html><body><ul role="tree"><li><span data-state="leaf"><span class="title">'
             '<a href="/data_sets/ds2.html#y">ds2</a></span></span></li>'
             '<li><span data-state="not-ready"><span class="title"><a id="data_sets.back" href="top.html">t</a>'
             '</span></span></li></ul></body></html>')
    pages = spark.createDataFrame([
        ("https://d.org/el.html", "element", el_index),
        ("https://d.org/top.html", "dataSet", tree1),
        ("https://d.org/sub.html", "dataSet", tree2),
    ], "url string, item_type string, html string")
    ent = {(r.item_type, r.href): (r.item_id, r.status) for r in dp.parse_index_pages(pages).collect()}
    assert ent[("element", "data_elements/e1.html")] == ("e1", "ok")
    assert ent[("element", "data_elements/bad.htm")] == ("", "no id")
    seeds = spark.createDataFrame([("https://d.org/top.html",)], "url string")
    got = sorted(r.item_id for r in dp.expand_index(pages.where("item_type = 'dataSet'"), seeds).collect())
    assert got == ["ds1", "ds2"]  # the back link to top.html is not expanded twice


def test_upsert_and_link_replace(spark):
    link = "array<struct<link_type:string,item_type:string,item_id:string>>"
    schema = f"item_type string, item_id string, name string, description string, meta string, links {link}, seq long"
    b1 = spark.createDataFrame([
        ("element", "e1", "E1", "d", None, [(None, "attribute", "a1"), ("x", "attribute", "a2")], 1),
        ("element", "e2", "E2", "d", None, [(None, "class", "missing")], 2),
        ("element", "e3", "E3", "d", None, [(None, "element", "e1")], 3),
    ], schema)
    d1 = dct.upsert(None, b1)
    l1 = dct.replace_links(None, b1)
    b2 = spark.createDataFrame([
        ("element", "e1", "E1b", "d2", '{"format":"f"}', [(None, "attribute", "a1")], 10),  # fewer links
        ("element", "e3", "E3b", "d2", None, None, 11),  # null links -> old links vanish
        ("element", "e3", "E3c", "d3", None, None, 12),  # later item in the batch wins
    ], schema)
    d2 = {(r.item_type, r.item_id): (r.name, r.meta) for r in dct.upsert(d1, b2).collect()}
    assert d2 == {("element", "e1"): ("E1b", '{"format":"f"}'), ("element", "e2"): ("E2", None),
                  ("element", "e3"): ("E3c", None)}
    l2 = sorted(tuple(r) for r in dct.replace_links(l1, b2).collect())
    assert l2 == [(None, "element", "e1", "attribute", "a1"), (None, "element", "e2", "class", "missing")]
    dic = dct.upsert(d1, b2)
    res = {(r.src_item_id, r.dst_item_id): r.resolved for r in dct.resolve_links(dct.replace_links(l1, b2), dic).collect()}
    assert res == {("e1", "a1"): False, ("e2", "missing"): False}
    assert dct.links_with_source(l1, dic.where("item_id <> 'e2'")).count() == 3


def test_distinct_links_keeps_first(spark):
    df = spark.createDataFrame([([("a", "t", "1"), ("b", "t", "2"), ("a", "t", "1"), ("a", "t", "3")],)],
                               "links array<struct<link_type:string,item_type:string,item_id:string>>")
    got = df.select(dct.distinct_links(F.col("links")).alias("l")).first().l
    assert [x.item_id for x in got] == ["1", "2", "3"]
