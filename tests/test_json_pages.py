"""S2/S3/N1 JSON pages: fixtures F4 (index) and F5 (nested articles)."""

import json


from quire.sources import jsonpages as jp


def test_index_pages(spark):
    def page(results, other=True, nexts=()):
        sig = [{"linkRelationship": "Result", "url": u} for u in results]
        if other:
            sig.insert(1, {"linkRelationship": "Related", "url": "r"})
        rel = [{"name": "Next Page", "url": n} for n in nexts]
        return json.dumps({"relatedLink": rel, "significantLink": sig})

    rows = [(1, page(["a", "b", "c"], nexts=["n1"])), (2, page([], nexts=["n2", "n3"])), (3, page([], other=False))]
    df = spark.createDataFrame(rows, "page_id long, body string")
    got = sorted((r.page_id, r.kind, r.position, r.url, r.priority, r.next_page)
                 for r in jp.parse_index(df, keys=["page_id"]).collect())
    assert got == [(1, "item", 0, "a", 0, "n1"), (1, "item", 1, "b", -1, "n1"), (1, "item", 2, "c", -2, "n1"),
                   (2, "index", None, "n2", 0, None)]


def test_nested_article(spark):
    body = {"dateModified": "2024-03-04T05:06:07+00:00", "mainEntityOfPage": [
        {"name": "markdown", "text": "A", "mainEntityOfPage": [
            {"name": "other", "text": "x", "mainEntityOfPage": [{"name": "markdown", "text": "B"}]},
            {"name": "markdown", "text": "C", "mainEntityOfPage": "string: not descended"},
        ]},
        {"name": "markdown", "text": "D"},
    ]}
    rows = [("u1", 200, json.dumps(body)), ("u2", 200, json.dumps({"dateModified": "2024-01-01"})),
            ("u3", 404, json.dumps(body))]
    df = spark.createDataFrame(rows, "url string, status int, body string")
    got = {r.url: (r.html, r.modified_at) for r in jp.parse_article(df).collect()}
    assert got["u1"][0] == "ABCD"
    assert got["u1"][1] is not None
    assert got["u2"][0] == ""
    assert got["u3"] == ("", None)
    kept, empty = jp.drop_empty(jp.parse_article(df))
    assert kept.count() == 1 and empty.count() == 2
