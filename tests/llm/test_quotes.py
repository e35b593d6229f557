"""Quote levels, links, reply order."""

from quire.llm import quotes

SCHEMA = "thread long, msg long, role string, text string, parent string, own string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "p", "o") for r in rows], SCHEMA)
    out = quotes.formatted(df, "thread", "msg", "role", "text")
    assert out.columns == ["thread", "msg", "role", "own_text", "n_quotes", "n_linked", "parent", "root", "depth", "chat"]
    return {(r["thread"], r["msg"]): r for r in out.collect()}


def test_thread(spark):
    rows = [
        (1, 0, "user", "First line\nsecond  LINE\n\nLast paragraph"),
        (1, 1, "assistant", "Ann wrote:\n> first line\n> Second line\n>\n> last paragraph\n\nMy answer"),
        (1, 2, "user", "> > First line\n> > second line\n>>\n> > Last paragraph\n> My answer\nThanks"),
        (1, 3, "user", "> Last   paragraph\nonly that part"),
        (1, 4, "user", "> nobody said this\nhm"),
        (1, 5, "user", "top\n> THANKS\nbetween\n> only that part\nend"),
        (2, 0, "user", "> First line\nother thread"),
        (2, 1, None, None),
    ]
    got = run(spark, rows)
    assert got[1, 1]["own_text"] == "My answer" and got[1, 1]["parent"] == 0
    assert got[1, 2]["own_text"] == "Thanks" and got[1, 2]["parent"] == 1 and (got[1, 2]["root"], got[1, 2]["depth"]) == (0, 2)
    assert (got[1, 2]["n_quotes"], got[1, 2]["n_linked"]) == (2, 2)
    assert got[1, 3]["parent"] == 0 and got[1, 3]["depth"] == 1
    assert got[1, 4]["parent"] is None and (got[1, 4]["root"], got[1, 4]["n_quotes"], got[1, 4]["n_linked"]) == (4, 1, 0)
    assert got[1, 5]["own_text"] == "top\nbetween\nend" and got[1, 5]["parent"] == 3      # the latest of its originals
    assert got[2, 0]["parent"] is None and got[2, 1]["own_text"] == ""
    assert got[2, 1]["chat"] == "<|user|>\n\n<|end|>\n"
    order = sorted((r for k, r in got.items() if k[0] == 1), key=lambda r: (r["root"], r["depth"], r["msg"]))
    place = {r["msg"]: k for k, r in enumerate(order)}
    assert all(place[r["parent"]] < place[r["msg"]] for r in order if r["parent"] is not None)


def test_long_chain(spark):
    rows = [(7, 0, "user", "message 0")] + [(7, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(1, 150)]
    got = run(spark, rows)
    assert all((got[7, i]["root"], got[7, i]["depth"]) == (0, i) for i in range(150))


def test_common_line_does_not_multiply(spark):
    rows = [(1, i, "user", "> thanks\nthanks" if i else "thanks") for i in range(300)]
    got = run(spark, rows)
    assert len(got) == 300 and all(got[1, i]["parent"] == 0 for i in range(1, 300))


def test_edges(spark):
    rows = [(None, 1, "user", "a"), (3, None, "user", "> a\nb"), (4, 0, "user", ">\n> \n"), (4, 0, "user", ">\n> \n"),
            (5, 0, "user", "x" * 100_000), (5, 1, "user", "> " + "x" * 100_000)]
    df = spark.createDataFrame([(*r, "p", "o") for r in rows], SCHEMA)
    got = quotes.formatted(df, "thread", "msg", "role", "text").collect()
    assert len(got) == 5
    by = {(r["thread"], r["msg"]): r for r in got}
    assert by[None, 1]["root"] is None and by[3, None]["own_text"] == "b" and by[4, 0]["n_quotes"] == 0 and by[5, 1]["parent"] == 0
    assert quotes.formatted(df.limit(0), "thread", "msg", "role", "text").count() == 0
    plan = quotes.formatted(df, "thread", "msg", "role", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
