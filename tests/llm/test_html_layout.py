"""Tree building, visibility and layout."""

import html
import re

import pytest

from quire.llm.html_layout import extracted, parse, visible_text

CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "<div>a</div><div>b</div>": "a\nb",
    "a  \n b&amp;&eacute;&#8217;": "a b&é’",
    "x<br>y<br><br>z": "x\ny\n\nz",
    "<h1>t</h1>text<ul><li>a<li>b<ol start=9><li>c<li>d</ol></ul>": "t\n\ntext\n\n* a\n* b\n  9. c\n  10. d",
    "<ol reversed><li>a<li>b<li value=7>c</ol>": "2. a\n1. b\n7. c".replace("2. a\n1. b", "3. a\n2. b"),
    "<ul><li><p>a</p><p>b</p></li></ul>": "* a\n\n  b",
    "<pre>\n a\n\n  b </pre>": " a\n\n  b ",
    "<blockquote>q</blockquote>r": "    q\n\nr",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n    d\nu",
    "<table><tr><th>Name<th>N<tr><td>ab<td>3</table>": "Name  N\nab    3",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide one<td>x<tr><td>a<td>b<td>c</table>": "wide one  x\na  b  c",
    "<table><caption>Cap</caption><tbody><tr><td>1<table><tr><td>in</table><td>2</table>": "Cap\n1   2\n\nin",
    "<td>loose</td>": "loose",
    "<div hidden>a</div><p style='display: none'>b</p><template>c</template><script>d<p></script>e": "e",
    "<p style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</p>": "b",
    "<details><summary>s</summary>closed</details><details open><summary>t</summary>open</details>": "s\nt\nopen",
    "<title>no</title><noscript>yes</noscript>": "yes",
    "<a title='x>y' href=\"a'b\">k</a>": "k",
    "a<!-- <b>no</b> -->b<!-->c<![CDATA[no]]>d<?no?>e": "abcde",
    "<script>if (a</b) '</scr' + 'ipt>'</script >after": "after",
    "<textarea>\n a&lt; </textarea>": " a< ",
    "<b>bold<i>both</b>it</i>": "boldbothit",
    "</p></div>x</body>y": "xy",
    "a < b <3": "a < b <3",
    "<p/>a<br/>b": "a\nb",
    "a&nbsp;&nbsp;b": "a  b",
    "<select><option>a<option>b</select>": "a\nb",
    "<div style='display:inline'>a</div><span style='display:block'>b</span>c": "a\nb\nc",
    "<input value=go type=submit><input type=hidden value=x>": "go",
    "<style>.h{display:none}</style><p class=h>a<p class='x h'>b<p>c": "c",
    "<style>/* .h */ p#i, .v .w {display:none} b{visibility:hidden}</style><p id=i>a<p class=w>b<b>c<i style='visibility:visible'>d</i></b>": "bd",
    "<style>p{display:none} p.s{display:block}</style><p>a<p class=s>b": "b",
    "<style>.h{display:none!important}</style><p class=h style='display:block'>a<p style='display:none'>b<p>c": "c",
    "<style>@media print{p{display:none}} @media screen{.q{display:none}} @import 'x'; u{display:none</style><p>a<p class=q>b<u>c</u>": "a",
    "<style media=print>p{display:none}</style><p>a": "a",
    "<table><tr><td>漢字<td>b<tr><td>abcd<td>c<tr><td>e\u0301<td>d</table>": "漢字  b\nabcd  c\ne\u0301     d",
    "<table><tr><td rowspan=3>a<td rowspan=2>b<td>c<tr><td>d<tr><td>e<td>f</table>": "a  b  c\n      d\n   e  f",
    "": "", " \n ": "", "<": "<", "<p": "", "<!--": "", "</": "</",
}


@pytest.mark.parametrize("page", sorted(CASES))
def test_layout(page):
    assert visible_text(page) == CASES[page]


def test_all_text_of_plain_pages(spark):
    """Words of a page without hidden parts come out whole and in order."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        body = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r["html"])
        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).replace("\xa0", " ").split()
        out = re.sub(r"(?m)^\s*(\*|\d+\.) ", "", visible_text(r["html"])).split()
        assert "".join(out).replace("*", "") == "".join(words).replace("*", "")


def test_depth_and_size():
    assert visible_text("<div>" * 5000 + "x") == "x"
    assert visible_text("<ul><li>" * 300 + "x").endswith("x")
    assert len(visible_text("<p>word " * 100_000).split()) == 100_000
    assert visible_text("<b" + " a" * 50_000 + ">t") == "t"
    assert visible_text("<table>" + "<tr><td colspan=1000>x" * 500) == "\n".join(["x"] * 500)
    assert visible_text("<table><tr><td>" + "y" * 5000 + "<td>a<tr><td>b<td>c</table>") == "y" * 5000 + "  a\nb  c"


def test_spans_are_ranges():
    """Wide and tall cells hold ranges of columns, not columns one by one."""
    import time

    page = "<table><tr>" + "<td colspan=1000 rowspan=0>x" * 300 + "<tr><td>y" * 300 + "</table>"
    begun = time.process_time()
    text = visible_text(page)
    assert time.process_time() - begun < 1 and text.count("x") == 300 and text.count("y") == 300
    mixed = "".join(f"<tr><td rowspan={k % 5} colspan={k % 3}>c{k}<td>d{k}" for k in range(400))
    assert all(f"c{k}" in (out := visible_text(f"<table>{mixed}</table>")) for k in (0, 200, 399)) and "d399" in out


def test_implied_ends():
    def tags(n):
        return [n.tag, *(tags(c) for c in n.children if not isinstance(c, str))]
    assert tags(parse("<table><tr><td>a<tr><td>b</table>")) == ["html", ["table", ["tr", ["td"]], ["tr", ["td"]]]]
    assert tags(parse("<p>a<div>b</div>")) == ["html", ["p"], ["div"]]
    assert tags(parse("<head><title>t</title><body><p>x")) == ["html", ["head", ["title"]], ["body", ["p"]]]


def test_dataframe(spark):
    df = spark.createDataFrame([(1, "u", "<p>a<p>b", 5), (None, "u", None, 6), (2, None, "", 7), (1, "u", "<p>a<p>b", 8)],
                               "page_id long, url string, html string, text int")
    got = sorted([tuple(r) for r in extracted(df).collect()], key=str)
    assert got == sorted([(1, "a\n\nb", 3), (1, "a\n\nb", 3), (None, None, 0), (2, "", 0)], key=str)
    assert extracted(df.limit(0)).count() == 0
