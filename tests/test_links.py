"""Anchors, URL resolution, allow-list, first-seen dedup."""

from urllib.parse import urljoin

from quire.operators import links as lk

BASES = ["http://h.org/a/b.html?q=1#f", "https://h.org", "https://h.org/dir/", "http://h.org/a?x"]
HREFS = ["/root", "rel.html", "sub/x", "?q=2", "#top", "", "//cdn.org/x", "https://o.org/p",
         "../up.html", "./same", "a/../b", "mailto:x@y.org", "../../../x", "..", ".", "a/./b/../c?x#y",
         "/a/../b", "../", "a//b/../c", "./?q"]


def test_resolve_equals_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "base string, href string")
    got = {(r.base, r.href): r.abs_url for r in lk.resolve_links(df, "base", "href").collect()}
    for b, h in rows:
        assert got[(b, h)] == urljoin(b, h), (b, h)


def test_page_links_region_allow_first_seen(spark):
    html1 = ('<nav><a href="/x">x</a><a class="c" href="/y">y</a></nav>'
             '<article><a href="/z">z</a></article><nav><a href="/x">again</a></nav>')
    html2 = '<nav><a href="https://other.org/x">o</a><a href="/x">x</a></nav>'
    pages = spark.createDataFrame([(1, "http://s.org/p", html1), (2, "http://s.org/q", html2)],
                                  "page_id long, url string, html string")
    all_links = lk.page_links(pages)
    assert all_links.count() == 6
    nav = lk.allowed(lk.page_links(pages, region_tag="nav"), r"^http://s\.org/")
    got = sorted((r.url, r.page_id, r.pos, r.n_refs) for r in lk.first_seen(nav).collect())
    assert got == [("http://s.org/x", 1, 0, 3), ("http://s.org/y", 1, 1, 1)]


def test_resolve_random_dot_paths(spark):
    import random

    rnd = random.Random(11)
    parts = ["a", "b", "..", ".", "", "c.html"]
    rows = []
    for _ in range(2000):
        href = "/".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 6)))
        if rnd.random() < 0.3:
            href = "/" + href
        rows.append((rnd.choice(BASES), href))
    df = spark.createDataFrame(rows, "base string, href string")
    for r in lk.resolve_links(df, "base", "href").collect():
        assert r.abs_url == urljoin(r.base, r.href), (r.base, r.href)


def test_anchors_equal_dom_hrefs(spark):
    import random as _r

    from quire.sources import html_tree as ht

    rnd = _r.Random(4)
    hrefs = ["/a", "b.html?x=1&amp;y=2", "http://h.org/c d", "#top", "", "q&quot;z"]
    forms = ['<a href="{}">t</a>', "<a href='{}'>t</a>", '<A class="k" HREF = "{}">t</A>',
             '<a data-href="/no" href="{}">t</a>', "<a\nhref='{}'\n>t</a>"]
    pages = []
    for _ in range(200):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            h = rnd.choice(hrefs)
            parts.append(rnd.choice(forms).format(h) + " text ")
            if rnd.random() < 0.3 and " " not in h and "&" not in h and h:
                parts.append(f"<a href={h}>bare</a>")
        pages.append(("".join(parts),))
    df = spark.createDataFrame(pages, "html string")
    for r in df.select("html", lk.anchors("html").alias("h")).collect():
        want = [a.attrs.get("href") for a in ht.parse(r.html).find_all("a") if "href" in a.attrs]
        assert list(r.h) == want, r.html


def test_regions_equal_the_tree(spark):
    """Balanced blocks: nested blocks of the same tag, classes, comments and scripts with tags in them."""
    import random as _r

    from quire.sources import html_tree as ht

    rnd = _r.Random(11)

    def block(depth):
        inner = "".join(rnd.choice([f"t{rnd.randrange(99)}", "<p>x</p>", "<!-- </div> -->", "<script>'<div>'</script>", f'<a href="/{rnd.randrange(99)}">l</a>',
                                    block(depth - 1) if depth else ""]) for _ in range(rnd.randint(0, 4)))
        return f'<{"DIV" if rnd.random() < .2 else "div"} id="a" class="{rnd.choice(["", "post", "x post y", "posts"])}">{inner}</div>'

    pages = ["".join(block(3) for _ in range(rnd.randint(0, 3))) for _ in range(150)] + ["", "<div class=post>open <div>in</div> end", "</div><div class='post'>a</div>"]
    df = spark.createDataFrame([(p,) for p in pages] + [(None,)], "html string")
    got = df.select("html", lk.regions("html", "div", "post").alias("r"), lk.anchors(lk.region("html", "div", "post")).alias("h")).collect()
    for r in got:
        tops = [e for e in ht.select(ht.parse(r.html or ""), "div", "post") if not any("post" in (a.attrs.get("class") or "").split() for a in ht.ancestors(e))]
        assert len(r.r) == len(tops), r.html
        assert list(r.h) == [a.attrs["href"] for e in tops for a in e.find_all("a")], r.html


def test_link_with_class(spark):
    rows = [('<a class="x" href="/1">a</a><a href="/2" class="y older-posts">b</a>',), ('<a class=older-posts href=/3?a&amp;b>',), ("<a class='older'>",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "html string").select(lk.link_with_class("html", "older-posts")).collect()]
    assert got == ["/2", "/3?a&b", None, None]
