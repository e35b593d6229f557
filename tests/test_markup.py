"""F1 markup to text: fixture F3 and native-vs-parser on real pages."""

import random

import pytest

from quire.functions.markup import _strip_one, strip_tags, strip_tags_exact

# (html, expected) - expected values follow the parser rules in the survey.
F3 = [
    ("a<br>b<p>c", "abc"),
    ("<p>AT&T</p>", "AT&T"),
    ("AT&T", ""),
    ("<p>x</p>tail &amp; more", "xtail & more"),
    ("a < b", "a < b"),
    ("x <", "x "),
    ("x <b", "x "),
    ("x<!-- c -->y", "xy"),
    ("x<!-- open", "x"),
    ('<script>var a="</p>";</script>z', 'var a="</p>";z'),
    ("<style>p{}</style>q", "p{}q"),
    ("<title>a&amp;b</title>", "a&b"),
    ("1 &lt; 2", "1 < 2"),
    ('<a href="x>y">k</a>', "k"),
]


@pytest.fixture(scope="module")
def f3(spark):
    return spark.createDataFrame([(i, h, e) for i, (h, e) in enumerate(F3)], "id long, html string, expected string")


def test_exact_matches_fixture(f3):
    rows = f3.select("id", "expected", strip_tags_exact("html").alias("got")).collect()
    for r in rows:
        assert r.got == r.expected, (r.id, F3[r.id][0])


def test_native_matches_fixture(f3):
    rows = f3.select("id", "expected", strip_tags("html").alias("got")).collect()
    for r in rows:
        assert r.got == r.expected, (r.id, F3[r.id][0], r.got)


def test_native_equals_parser_on_fuzzed_markup(spark):
    import random

    rnd = random.Random(3)
    parts = ["a", " b ", "AT&T", "&amp;", "&lt;", "<p>", "</p>", "<br>", '<b class="x">', "</b>", "<!-- c -->",
             "<!--", "<", "< ", '<a href="x>y">', "</a>", "<script>var a='</p>';</script>", "<style>p{}</style>",
             "<!DOCTYPE html>", "&", ";", "\n", "<?pi x?>", "</ x>", "é", "&copy;"]
    rows = [("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 8))),) for _ in range(1500)]
    df = spark.createDataFrame(rows, "html string")
    assert df.where(strip_tags("html") != strip_tags_exact("html")).count() == 0


def test_null_in_null_out(spark):
    df = spark.createDataFrame([(None,)], "html string")
    assert df.select(strip_tags("html").alias("t")).first().t is None


def test_native_equals_parser_on_pages(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    diff = p.where(strip_tags("html") != strip_tags_exact("html")).count()
    assert diff == 0


def test_native_plan_has_no_python(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(strip_tags("html").alias("t"))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_native_equals_parser_on_malformed_tags(spark):
    import random

    rnd = random.Random(8)
    parts = ["a", " ", "<P>", "</P>", "<DIV class='k'>", "<a title='x>y' href=\"z\">", "<img src=x>", "<br/>",
             "<SCRIPT type=\"t\">if(a<b&&c)x='</p>'</SCRIPT>", "<script>a</script >", "<style media=x>p>q{}</style>",
             "&gt;", "&#39;", "&", "&x", "<!---->", "<!x y>", ">", "<b", "</", "<!", "<?", "<a href=\"&amp;x\">",
             "<scripts>", "=", "'", '"', "<a x=='v>w'>", "<a x= >"]
    rows = [("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 9))),) for _ in range(2000)]
    df = spark.createDataFrame(rows, "html string")
    assert df.where(strip_tags("html") != strip_tags_exact("html")).count() == 0


def test_pathological_markup_stays_safe(spark):
    # cut-off and closed tags with thousands of quoted attributes: read whole, no stack overflow
    long = "k=\"v>w\" " * 20000
    rows = [('<a ' + 'x="1" ' * 30 + 'y',), ("text <b " + long,), ("text <b " + long + ">z .",), ("<script>" + "a<b;" * 20000,),
            ("<i " + "a " * 50000 + "t='>'>k .",), ("<b " + "=" * 5000 + ">k .",)]
    got = [r.t for r in spark.createDataFrame(rows, "h string").select(strip_tags("h").alias("t")).collect()]
    assert got == [_strip_one(h) for h, in rows]


def test_every_reference_equals_the_parser(spark):
    from html.entities import html5

    rng = random.Random(3)
    numbers = [*range(300), 0xD800, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x1FFFE, 0x10FFFF, 0x110000, 99999999999, 8211, 128512]
    refs = ["&" + n for n in html5] + [f"&#{n};" for n in numbers] + [f"&#x{n:X}" for n in numbers]
    refs += ["&#0000233;", "&#x;", "&#;", "&bogus;", "&ampb", "&lt5", "&notit;", "&notin;", "&", "&&amp", "&a", "&#38;amp;"]
    rows = [(r + "z .",) for r in refs]
    rows += [("".join(rng.choice([*refs, " ", "a", ";", "<b>", "é"]) for _ in range(12)) + " .",) for _ in range(2000)]
    got = spark.createDataFrame(rows, "h string").select("h", strip_tags("h").alias("t")).collect()
    assert [(r.h, r.t) for r in got if r.t != _strip_one(r.h)] == []
