"""Multi-word term coding (R6): the longest term at every position.

The code list becomes a prefix table: every leading word run of a term, with
its code if it is a term itself and whether a longer term goes on from it. A
text position walks down that table one word at a time, so words that start no
term leave after the first look-up. Of overlapping matches the leftmost one
stays (at one position the longest), the next one starts behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.spans import exclusive_prefix
from quire.session import bounded_broadcast, spread

MAX_WORDS = 8
MAX_PREFIXES = 5_000_000
STRETCH = 8
WORD = r"(\p{L}+)"


def words(text):
    """Lower-case words of a text, as a code list's terms are cut."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 1)


def prefix_table(terms: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``terms`` (term, code) -> (n, prefix, code, longer); of several codes of
    a term the smallest counts. Terms of more than ``max_words`` words do not
    take part."""
    t = terms.select(words("term").alias("w"), "code").where((F.size("w") > 0) & (F.size("w") <= max_words))
    runs = t.select("w", "code", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("n"))
    whole = F.col("n") == F.size("w")
    return (runs.groupBy("n", F.array_join(F.slice("w", 1, F.col("n")), " ").alias("prefix"))
            .agg(F.min(F.when(whole, F.col("code"))).alias("code"), F.bool_or(~whole).alias("longer")))


def positions(docs: DataFrame, key: str, text: str, max_words: int) -> DataFrame:
    """(key, pos, word, i, base, w, steps, sizes): every word of a text, in
    lower case. Texts are cut into stretches of ``STRETCH`` words with those a
    term may go on to (``w``), so that a word carries a few neighbours and not
    a list of its own; it is the ``i``-th (from 0) of its stretch, which starts
    at offset ``base``. ``steps`` are the lengths of words with the gap before
    them, ``sizes`` without."""
    # a file's few row groups must not decide how many tasks walk the words
    docs = spread(docs.select(key, text))
    cut = docs.select(key, F.regexp_extract_all(text, F.lit(WORD), 1).alias("ws"), F.split(text, WORD, -1).alias("gaps"))
    length = lambda x: F.length(x).cast("long")
    cut = cut.select(key, F.transform("ws", F.lower).alias("w"), F.transform("ws", length).alias("sizes"),
                     F.zip_with(F.slice("gaps", 1, F.size("ws")), "ws", lambda g, x: length(g) + length(x)).alias("steps"))
    count = F.ceil(F.size("w") / STRETCH).cast("int")
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    total = lambda k: F.aggregate(F.slice("steps", k * STRETCH + 1, STRETCH), F.lit(0).cast("long"), lambda a, x: a + x)
    cut = cut.select("*", exclusive_prefix(F.transform(places, total)).alias("bases"))
    wide = STRETCH + max_words - 1
    own = lambda c, k: F.slice(c, k * STRETCH + 1, wide).alias(c)
    rows = cut.select(key, F.explode(F.transform(places, lambda k: F.struct(
        k.alias("k"), F.get("bases", k).alias("base"), own("w", k), own("steps", k), own("sizes", k)))).alias("p"))
    rows = rows.select(key, "p.*").select("*", F.posexplode(F.slice("w", 1, STRETCH)).alias("i", "word"))
    return rows.select(key, (F.col("k").cast("long") * STRETCH + F.col("i")).alias("pos"), "word", "i", "base", "w", "steps", "sizes")


def longest_matches(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """(key, pos, n_words, start_offset, end_offset, term, code): the longest
    term at every word position, overlaps included."""
    table, _ = bounded_broadcast(prefix_table(terms, max_words), MAX_PREFIXES)
    rows = positions(docs, key, text, max_words).withColumn("_alive", F.lit(True))
    rows = rows.withColumn("_best", F.lit(None).cast("struct<n:int,code:string>"))
    words_of = lambda n: F.array_join(F.slice("w", F.col("i") + 1, n), " ")
    for n in range(1, max_words + 1):
        step = table.where(F.col("n") == n).select(F.col("prefix").alias("_prefix"), F.col("code").alias("_code"), F.col("longer").alias("_longer"))
        run = F.col("word") if n == 1 else F.when(F.col("_alive") & (F.size("w") >= F.col("i") + n), words_of(n))
        rows = rows.join(step, run == F.col("_prefix"), "inner" if n == 1 else "left")
        found = F.when(F.col("_code").isNotNull(), F.struct(F.lit(n).alias("n"), F.col("_code").cast("string").alias("code")))
        rows = (rows.withColumn("_best", F.coalesce(found, "_best")).withColumn("_alive", F.coalesce("_longer", F.lit(False)))
                .drop("_prefix", "_code", "_longer").where("_alive OR _best IS NOT NULL"))
    rows = rows.where("_best IS NOT NULL")
    upto = lambda n: F.col("base") + F.aggregate(F.slice("steps", 1, n), F.lit(0).cast("long"), lambda a, x: a + x)
    n_words = F.col("_best.n")
    return rows.select(key, "pos", n_words.alias("n_words"), (upto(F.col("i") + 1) - F.get("sizes", "i")).alias("start_offset"),
                       upto(F.col("i") + n_words).alias("end_offset"), words_of(n_words).alias("term"), F.col("_best.code").alias("code"))


def leftmost(matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """Matches without overlaps. Matches that touch no other one stay as they
    are; only runs of overlapping ones are walked from left to right."""
    w = Window.partitionBy(key).orderBy("pos")
    reach = F.max(F.col("pos") + F.col("n_words")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = matches.withColumn("_new", F.coalesce(F.col("pos") >= reach, F.lit(True)).cast("int"))
    runs = runs.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rest = [c for c in matches.columns if c not in (key, "pos")]
    grouped = runs.groupBy(key, "_run").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("m"))
    empty = F.slice("m", 1, 0)

    def step(acc, x):
        keep = x["pos"] >= acc["upto"]
        return F.struct(F.when(keep, x["pos"] + x["n_words"]).otherwise(acc["upto"]).alias("upto"),
                        F.when(keep, F.array_append(acc["out"], x)).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate("m", F.struct(F.lit(0).cast("long").alias("upto"), empty.alias("out")), step, lambda acc: acc["out"])
    kept = F.when(F.size("m") == 1, F.col("m")).otherwise(walked)
    return grouped.select(key, F.explode(kept).alias("x")).select(key, "x.*")


def coded(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """Terms of a code list (``term``, ``code``) found in the texts, with
    offsets, longest leftmost and without overlaps."""
    return leftmost(longest_matches(docs, terms, key, text, max_words), key)
