"""Quotation linking of messages, in DataFrame operations only.

A line's quote level is the number of ``>`` marks it starts with. Runs of
lines of one level form passages; level 0 is what the author wrote. Quoted
passages are normalised (lower case, blanks collapsed), hashed, and joined to
the units of the messages' own text: the whole text, its paragraphs and its
lines. Of several messages with the same unit the earliest one in the thread
is the original; units are reduced to it before the join, so that a common
line cannot multiply rows. A passage that matches no unit (it starts or ends
inside a line, or was wrapped anew) is looked up by its first ``PROBE`` words
among the word windows of the thread's texts, and linked to the earliest
message whose text holds its words in a row. A quote of level d then names the ancestor d steps
up; level 1 gives the parent. Roots and depths follow by pointer doubling, and
messages sorted by (thread, root, depth, order) are the conversation, without
quotes, every message behind the one it answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind
from quire.llm import common as C

MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)\bwrote:\s*$"
# Words by which a part of a text is found; shorter parts are not looked for.
PROBE = 4


def passages(text) -> Column:
    """array<struct<level, body>> of a text: runs of lines of one quote level,
    in order. A line ``... wrote:`` right before a deeper line is dropped."""
    def line(x):
        return bind(F.regexp_extract(x, MARKS, 0), lambda marks: F.struct(
            F.length(F.translate(marks, " \t", "")).alias("level"),
            F.when(marks == "", x).otherwise(F.regexp_replace(F.substr(x, F.length(marks) + 1), r"^ ", "")).alias("body")))

    def kept(lines):
        return F.filter(lines, lambda x, i: ~(F.regexp_like(x["body"], F.lit(ATTRIBUTION)) & F.coalesce(
            F.get(lines, i + 1)["level"] > x["level"], F.lit(False))))

    def runs(lines):
        n = F.size(lines)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (
            F.element_at(lines, i)["level"] != F.element_at(lines, F.least(i + 1, n))["level"]))
        return bind(ends, lambda e: F.transform(e, lambda end, k: bind(
            F.when(k > 0, F.element_at(e, F.greatest(k, F.lit(1)))).otherwise(F.lit(0)), lambda start: F.struct(
                F.element_at(lines, end)["level"].alias("level"),
                F.array_join(F.transform(F.slice(lines, start + 1, end - start), lambda x: x["body"]), "\n").alias("body")))))

    split = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), line)
    return bind(split, lambda ls: bind(kept(ls), lambda ks: F.when(F.size(ks) > 0, runs(ks)).otherwise(
        F.array().cast("array<struct<level:int,body:string>>"))))


def normalised(text) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(body) -> Column:
    """Normalised whole text, paragraphs and lines, without repeats or empty ones."""
    pieces = F.concat(F.array(body), F.split(body, r"\n[ \t]*\n", -1), F.split(body, "\n", -1))
    return F.array_distinct(F.filter(F.transform(pieces, normalised), lambda x: x != ""))


def own_text(parts) -> Column:
    """Level-0 passages joined, without blank lines at either end."""
    return F.regexp_replace(F.array_join(F.transform(F.filter(parts, lambda p: p["level"] == 0), lambda p: p["body"]), "\n"),
                            r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")


def quote_links(parsed: DataFrame) -> DataFrame:
    """(thread, msg, part, level, rank, source): the message that each quoted passage
    of a message repeats; ``part`` is the passage's place among all its passages."""
    units = parsed.select("thread", "msg", F.explode(_units(F.col("own"))).alias("u"))
    units = units.select("thread", F.md5("u").alias("key"), "msg").groupBy("thread", "key").agg(F.min("msg").alias("source"))
    quoted = parsed.select("thread", "msg", F.posexplode("parts").alias("part", "p")).where("p.level > 0")
    # rank 0: the passage as a whole; rank 1: one of its lines
    pieces = F.concat(F.array(F.struct(F.lit(0).alias("rank"), normalised(F.col("p.body")).alias("u"))),
                      F.transform(F.split("p.body", "\n", -1), lambda x: F.struct(F.lit(1).alias("rank"), normalised(x).alias("u"))))
    quotes = quoted.select("thread", "msg", "part", F.col("p.level").alias("level"), F.explode(pieces).alias("q")).where("q.u <> ''")
    quotes = (quotes.select("thread", "msg", "part", "level", F.md5("q.u").alias("key"), F.col("q.rank").alias("rank"))
              .groupBy("thread", "msg", "part", "level", "key").agg(F.min("rank").alias("rank")))
    hits = quotes.join(units, ["thread", "key"]).where("source < msg")
    # whole passages before lines, then the latest of the originals
    exact = (hits.groupBy("thread", "msg", "part", "level").agg(F.min(F.struct("rank", (-F.col("source")).alias("back"))).alias("b"))
             .select("thread", "msg", "part", "level", F.col("b.rank").alias("rank"), (-F.col("b.back")).alias("source")))
    exact = C.stored(exact, "quotes-exact")
    missed = (quoted.select("thread", "msg", "part", F.col("p.level").alias("level"), normalised(F.col("p.body")).alias("u"))
              .join(exact.select("thread", "msg", "part"), ["thread", "msg", "part"], "left_anti"))
    return exact.unionByName(_partial(missed.where(F.size(F.split("u", " ")) >= PROBE), parsed))


def _partial(missed: DataFrame, parsed: DataFrame) -> DataFrame:
    """Links of passages that are a run of words inside an earlier text.

    One probe per passage meets the word windows of its thread. Windows are
    made in threads with a probe only, and of equal texts once (for the
    earliest message); texts are compared where a window is found."""
    missed = C.stored(missed.withColumn("probe", F.xxhash64(F.slice(F.split("u", " "), 1, PROBE))), "quotes-missed")
    texts = (parsed.join(missed.select("thread").distinct(), "thread", "left_semi").select("thread", "msg", normalised(F.col("own")).alias("text"))
             .groupBy("thread", F.md5("text").alias("h")).agg(F.min("msg").alias("source"), F.first("text").alias("text")))
    texts = C.stored(texts.select("thread", "source", "text"), "quotes-texts")
    windows = texts.select("thread", "source", F.split("text", " ").alias("w")).where(F.size("w") >= PROBE)
    windows = windows.select("thread", "source", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("w") - PROBE + 1), lambda i: F.xxhash64(F.slice("w", i, PROBE))))).alias("probe"))
    near = (missed.select("thread", "msg", "part", "probe").join(windows, ["thread", "probe"]).where("source < msg")
            .select("thread", "msg", "part", "source"))
    found = (near.join(missed.select("thread", "msg", "part", "level", "u"), ["thread", "msg", "part"]).join(texts, ["thread", "source"])
             .where(F.concat(F.lit(" "), "text", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("u"), F.lit(" ")))))
    return (found.groupBy("thread", "msg", "part", "level").agg(F.min("source").alias("source"))
            .select("thread", "msg", "part", "level", F.lit(2).alias("rank"), "source"))


def linked(messages: DataFrame, thread_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """thread, msg, role, own_text, n_quotes, n_linked, parent, root, depth: one row per distinct message.

    ``order_col`` (integer) names a message within its thread. Rows that
    repeat thread and order are one message (the smallest role and text
    stand). Rows with a null thread or order cannot be linked: they come back
    as roots of their own with null parent and root. Null texts are empty;
    messages whose quotes match nothing are roots. n_quotes and n_linked count
    quoted passages; a message that quotes several at level 1 has the parent
    that is repeated whole, of several the latest. Other columns are not read.
    """
    src = messages.select(F.col(f"`{thread_col}`").alias("thread"), F.col(f"`{order_col}`").cast("long").alias("msg"),
                          F.col(f"`{role_col}`").alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keyed = F.col("thread").isNotNull() & F.col("msg").isNotNull()
    once = src.where(keyed).groupBy("thread", "msg").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    rows = once.unionByName(src.where(~keyed)).withColumn("parts", passages(F.col("text")))
    parsed = C.stored(rows.select("thread", "msg", "role", "parts", own_text(F.col("parts")).alias("own"))
                      .withColumn("n_quotes", F.size(F.filter("parts", lambda p: (p["level"] > 0) & (normalised(p["body"]) != "")))), "quotes-parsed")
    links = C.stored(quote_links(parsed.where("thread IS NOT NULL AND msg IS NOT NULL")), "quotes-links")
    # of several level-1 passages the parent is the one repeated whole, then the latest original
    parents = (links.where("level = 1").groupBy("thread", "msg")
               .agg(F.min(F.struct("rank", (-F.col("source")).alias("back"))).alias("b")).select("thread", "msg", (-F.col("b.back")).alias("parent")))
    roots = C.stored(_roots(parents), "quotes-roots")
    per = links.groupBy("thread", "msg").agg(F.count(F.lit(1)).alias("n_linked"))
    out = parsed.drop("parts").join(per, ["thread", "msg"], "left").join(roots, ["thread", "msg"], "left")
    return out.select("thread", "msg", "role", F.col("own").alias("own_text"), F.col("n_quotes").cast("long").alias("n_quotes"),
                      F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "parent",
                      F.coalesce("root", F.when(F.col("thread").isNotNull(), F.col("msg"))).alias("root"),
                      F.coalesce("depth", F.lit(0)).alias("depth"))


def _roots(parents: DataFrame) -> DataFrame:
    """(thread, msg, parent, root, depth) by pointer doubling: a chain of n
    replies takes log2(n) steps. Messages whose pointer has reached a root
    are set aside, so that a step only joins what still moves."""
    cols = ["thread", "msg", "parent", "root", "depth"]
    moving = C.stored(parents.select("thread", "msg", "parent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "quotes-step")
    done = moving.limit(0)
    while True:
        up = done.union(moving).select("thread", F.col("msg").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = C.stored(moving.join(up, ["thread", "root"], "left").select(
            "thread", "msg", "parent", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved")), "quotes-step")
        done, moving = done.union(step.where("NOT moved").select(cols)), step.where("moved").select(cols)
        if moving.head() is None:
            return done


def formatted(messages: DataFrame, thread_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """``linked`` with ``chat``, the message as a turn of a chat template.
    Sorted by thread, root, depth, msg the rows read as the conversations."""
    rows = linked(messages, thread_col, order_col, role_col, text_col)
    return rows.withColumn("chat", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "own_text", F.lit("\n<|end|>\n")))
