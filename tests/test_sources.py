"""Source jobs C3/C4/C5 on hand-written fixtures."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from quire.operators import ingest as ing
from quire.operators.frontier import walk
from quire.sources import extractors as ex


def _art(text, date="2024-01-01T00:00:00+00:00"):
    body = {"mainEntityOfPage": [{"name": "markdown", "text": text}]}
    if date:
        body["dateModified"] = date
    return json.dumps(body)


def test_conditions_items(spark):
    rows = [  # url, status, body, page_no, position, arrival (shuffled against position)
        ("u0", 200, _art("zero"), 1, 0, 5),
        ("u1", 404, _art("x"), 1, 1, 1),            # slot filled, no item
        ("u2", 200, _art("two", None), 1, 2, 2),    # no dateModified: rejected alone
        ("u3", 200, json.dumps({"dateModified": "2024-01-02", "other": 1}), 1, 3, 3),  # no text
        ("u4", 200, _art("four"), 1, 4, 4),
        ("u4b", 200, _art("dup"), 1, 4, 9),         # slot filled twice
        ("v0", 200, _art("p2-zero"), 2, 0, 6),
        ("v2", 200, _art("p2-two"), 2, 2, 7),       # waits behind empty slot 1
    ]
    df = spark.createDataFrame(rows, "url string, status int, body string, page_no long, position long, arrival long")
    items, rejects, pending = ex.conditions_items(df)
    got = [(r.seq, r.source_url, r.html) for r in items.orderBy("seq").collect()]
    assert got == [(0, "u0", "zero"), (1, "u4", "four"), (2, "v0", "p2-zero")]
    assert sorted((r.url, r.reason) for r in rejects.collect()) == [
        ("u1", "status 404"), ("u2", "no dateModified"), ("u3", "no text"), ("u4b", "slot already filled")]
    assert [r.url for r in pending.collect()] == ["v2"]
    ing_res = ing.ingest(items, None, spark.createDataFrame([], "source_id string, project_id long, dataset_id long"))
    assert ing_res.documents.count() == 3


def test_conditions_requests(spark):
    body = json.dumps({"relatedLink": [{"name": "Next Page", "url": "p2"}],
                       "significantLink": [{"linkRelationship": "Result", "url": "a"},
                                           {"linkRelationship": "Result", "url": "b"}]})
    df = spark.createDataFrame([(1, body)], "page_no long, body string")
    got = sorted((r.url, r.position, r.priority, r.force_refresh) for r in ex.conditions_requests(df).collect())
    assert got == [("a", 0, 0, True), ("b", 1, -1, True)]


LISTING1 = ('<html><body><div class="post"><a href="https://n.org/news/a">a</a>'
            '<a href="https://n.org/news/a">again</a><a href="/news/b">rel</a>'
            '<a href="https://elsewhere.org/news/x">out</a></div>'
            '<a href="https://n.org/news/outside">not in a post</a>'
            '<a class="older-posts" href="/list?page=2">older</a></body></html>')
LISTING2 = '<html><body><div class="post"><a href="https://n.org/news/c">c</a></div></body></html>'


def test_news_requests_and_walk(spark):
    listings = spark.createDataFrame([("https://n.org/list", LISTING1), ("https://n.org/list?page=2", LISTING2)],
                                     "url string, html string")
    ledger = spark.createDataFrame([("news", "https://n.org/news/b", dt.datetime(2024, 1, 1))],
                                   "source_id string, url string, modified_at timestamp")
    reqs, edges = ex.news_requests(listings, ledger, r"^https://n\.org/news/")
    assert sorted(r.url for r in reqs.collect()) == ["https://n.org/news/a", "https://n.org/news/c"]
    seeds = spark.createDataFrame([("https://n.org/list",)], "node string")
    assert sorted(r.node for r in walk(seeds, edges).collect()) == ["https://n.org/list", "https://n.org/list?page=2"]


def test_news_items_and_reviews(spark):
    arts = spark.createDataFrame([("https://n.org/news/a", '<div class="text"><p>Body</p></div>'),
                                  ("https://n.org/news/b", "<p>no block</p>")], "url string, html string")
    items, rejects = ex.news_items(arts, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert [(r.source_url, r.html) for r in items.collect()] == [("https://n.org/news/a", '<div class="text"><p>Body</p></div>')]
    assert [r.url for r in rejects.collect()] == ["https://n.org/news/b"]
    block = ('<section><div class="c" aria-label="Organisation review"><div><h3 id="x"><span>Rated<b>4</b>{h}</span></h3><p>1</p>'
             '<div><p>inner</p></div><p class="k">2</p><p>3</p>{t}<p>5</p><p><a class="z" href="{href}">Report</a></p></div></div></section>')
    text = '<p lang="en">Nice <i>staff</i></p>'
    page = ("<main>" + block.format(h=" Great ", t=text, href="report?commentID=c-1") + block.format(h="", t=text, href="report?commentID=c-2")
            + block.format(h="Bad", t=text, href="report") + block.format(h=" ", t=text, href="report?commentID=c-4")
            + '<div aria-label="Organisation review"><div><h3><span>a<b>1</b>h</span></h3><p>only</p></div></div></main>'
            + block.format(h="outside main", t=text, href="report?commentID=c-5"))
    pages = spark.createDataFrame([(1, "https://r.org/p", page)], "page_id long, url string, html string")
    items, rejects = ex.review_items(pages)
    assert [(r.source_url, r.html) for r in items.collect()] == [
        ("https://r.org/p#c-1", "Great. " + text), ("https://r.org/p#c-4", ". " + text)]
    assert sorted(r.reason for r in rejects.collect()) == ["no comment id", "no headline", "no text"]


def test_dictionary_items(spark):
    idx = ('<html><body><article id="dataElement_overview"><article>'
           '<a class="element" href="data_elements/e1.html">e1</a>'
           '<a class="element" href="data_elements/e2.htm">bad</a></article></article></body></html>')
    item = ('<html><head><meta name="name" content="E one"></head><body><div id="wh_topic_body">'
            '<article id="element_e1.description"><div class="body"><div>Desc '
            '<a class="attribute" href="../attributes/a1.html">a1</a></div></div></article></div></body></html>')
    index_pages = spark.createDataFrame([("https://d.org/el.html", "element", idx)], "url string, item_type string, html string")
    item_pages = spark.createDataFrame([("https://d.org/data_elements/e1.html", item, None)],
                                       "url string, html string, last_modified string")
    seeds = spark.createDataFrame([], "url string, item_type string")
    items, rejects = ex.dictionary_items(index_pages, item_pages, seeds)
    got = [(r.item_type, r.item_id, r.name, [(l.item_type, l.item_id) for l in r.links]) for r in items.collect()]
    assert got == [("element", "e1", "E one", [("attribute", "a1")])]
    assert [r.reason for r in rejects.collect()] == ["no id in href"]
    res = ing.ingest(items.withColumn("seq", F.lit(1).cast("long")), None,
                     spark.createDataFrame([], "source_id string, project_id long, dataset_id long"))
    assert res.dictionary.count() == 1 and res.links.count() == 1


def test_html_files_and_project_reads(spark):
    from quire.session import scratch_path

    d = scratch_path(spark, "htmlfiles")
    os.makedirs(d)
    for i, body in enumerate(["<p>one</p>", "<p>two\nlines</p>"]):
        with open(f"{d}/page{i}.html", "w", encoding="utf-8") as f:
            f.write(body)
    pages = ex.read_html_files(spark, d)
    got = sorted((r.url.rsplit("/", 1)[-1], r.html) for r in pages.collect())
    assert got == [("page0.html", "<p>one</p>"), ("page1.html", "<p>two\nlines</p>")]
    store = scratch_path(spark, "projdocs")
    spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "text string, project_id long") \
        .write.mode("overwrite").partitionBy("project_id").parquet(store)
    p1 = ex.project_documents(spark, store, 1)
    assert sorted(r.text for r in p1.collect()) == ["a", "c"]
    assert "PartitionFilters: [isnotnull(project_id" in p1._jdf.queryExecution().executedPlan().toString()
    s = ex.seeds(spark, {"news": ["https://n.org/"], "reviews": ["https://r.org/a", "https://r.org/b"]})
    assert s.count() == 3
