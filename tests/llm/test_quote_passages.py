"""Messages that quote several others at one level."""

from quire.llm import quotes

SCHEMA = "thread long, msg long, role string, text string"


def test_every_passage_is_linked(spark):
    rows = [(1, 0, "user", "first question\nwith a detail"), (1, 1, "user", "second question"), (1, 2, "user", "third one"),
            (1, 3, "user", "> first question\n> with a detail\nyes\n> second question\nno\n> third one\nmaybe\n> never written\nend"),
            (1, 4, "user", "> second question\nand\n> with a detail\nend of it"),
            (1, 5, "user", "> yes\n>> second question\n> no\nwell")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["msg"]: r for r in quotes.formatted(df, "thread", "msg", "role", "text").collect()}
    assert (got[3]["n_quotes"], got[3]["n_linked"], got[3]["parent"]) == (4, 3, 2)
    assert (got[4]["n_quotes"], got[4]["n_linked"], got[4]["parent"]) == (2, 2, 1)      # whole message before a line of one
    assert (got[5]["n_quotes"], got[5]["n_linked"], got[5]["parent"]) == (3, 3, 3)
    rows = df.selectExpr("thread", "msg", "text").withColumn("parts", quotes.passages(df["text"]))
    links = quotes.quote_links(rows.withColumn("own", quotes.own_text(rows["parts"])))
    assert {(r["msg"], r["part"], r["source"]) for r in links.collect() if r["msg"] == 3} == {(3, 0, 0), (3, 2, 1), (3, 4, 2)}


def test_parts_of_texts_are_linked(spark):
    """Quotations that start or end inside a line, or were wrapped anew, and what must not match."""
    rows = [("t", 1, "a", "one two three four five six\nseven eight nine ten\n\nother part here now"), ("t", 2, "a", "one two three four five six\nseven eight nine ten"),
            ("t", 3, "b", "> two three four five\nyes"), ("t", 4, "b", "> five six seven\n> eight nine\nno"), ("t", 5, "b", "> wo three four five\nx"),
            ("t", 6, "b", "> five six\nshort"), ("t", 7, "b", "> ten other part here\nover a paragraph"), ("u", 8, "b", "> two three four five\nother thread"),
            ("t", 9, "b", ">> seven eight nine ten\n> three four five six\nboth")]
    got = {r["msg"]: (r["n_quotes"], r["n_linked"], r["parent"]) for r in quotes.linked(
        spark.createDataFrame(rows, "thread string, msg long, role string, text string"), "thread", "msg", "role", "text").collect()}
    assert got == {1: (0, 0, None), 2: (0, 0, None), 3: (1, 1, 1), 4: (1, 1, 1), 5: (1, 0, None), 6: (1, 0, None), 7: (1, 1, 1),
                   8: (1, 0, None), 9: (2, 2, 1)}
