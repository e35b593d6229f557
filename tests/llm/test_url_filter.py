"""URL rules and the Bloom cascade against plain sets."""

import random

import pytest

from quire.llm import url_filter as uf

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
PAGES = "page_id long, url string, host int, rule string, key string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path


def rule(host, path):
    fits = [(len(r), r, v) for v, r in RULES for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def urls():
    rng = random.Random(6)
    tops, paths = ["example.org", "M.Example.ORG", "x.com", "a.b.com", "notorg", "org", "Ünï.net"], ["/es/1", "/en/1", "/en/2", "/fr/9", "/de/", "", "/"]
    out = [f"http{rng.choice(['', 's'])}://{rng.choice(tops)}{rng.choice(paths)}{rng.randint(0, 400) if rng.random() < .8 else ''}"
           f"{rng.choice(['', '?q=/es/', '#top', '?a#b'])}" for _ in range(900)]
    return out + [None, "", "no scheme", "://", "x://", "http://a?b://c/d", "http://org", "http://org/\nx", "HTTP://EXAMPLE.org/es/"]


@pytest.mark.parametrize("shard", [2_000_000, 40])
def test_verdicts(spark, shard):
    rows = [(i if i else None, u, i, "r", "k") for i, u in enumerate(urls())]
    keys = sorted({"".join(split(u)) for _, u, *_ in rows if split(u)[0]})
    listed = random.Random(1).sample(keys, len(keys) // 3)
    extra = [(k,) for k in [*listed, listed[0], "not.in/corpus", None]]
    got = uf.judged(spark.createDataFrame(rows, PAGES), spark.createDataFrame(extra, "key string"), RULES, shard_keys=shard)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "listed"]
    want = []
    for i, u, *_ in rows:
        host, path = split(u)
        text, verdict = rule(host, path)
        on = host != "" and host + path in listed
        want.append((i, host, path, text, verdict or ("block" if on else "allow"), on))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("n_listed,n_all", [(0, 50), (50, 50), (1, 3000), (1500, 3000)])
def test_membership_is_exact(spark, n_listed, n_all):
    universe = spark.range(n_all).selectExpr("concat('key', id) AS key")
    listed = universe.where(f"int(substr(key, 4)) < {n_listed}")
    cascade = uf.Cascade(listed, universe)
    got = cascade.mark(universe, "key").collect()
    assert {r["key"] for r in got if r["listed"]} == {f"key{i}" for i in range(n_listed)} and len(got) == n_all


def test_main_path_is_native(spark):
    rows = spark.createDataFrame([(1, "http://a.net/x", 0, "", "")], PAGES)
    df = uf.judged(rows, spark.createDataFrame([("a.net/x",)], "key string"), RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Join" not in plan.split("Subquery")[0].split("Initial Plan")[0]
    assert [r["verdict"] for r in df.collect()] == ["block"]
    assert uf.judged(rows.limit(0), spark.createDataFrame([], "key string"), RULES).count() == 0
