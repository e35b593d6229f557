"""Quality rules from what public vocabularies make of a text.

Three measures of a document: characters per token of a byte-level BPE, share
of byte-fallback tokens of a piece vocabulary, and the entropy of the byte-BPE
token distribution. Tokens are those of the words, each behind one blank, so
that layout does not count. Rejection bands come from the corpus itself, per
language (or script where no language is given): median and interquartile
range over all documents that pass the base rules, drawn towards those of the
script and of the corpus as by ``PRIOR_DOCS`` more documents, so a language
with few documents is judged mostly by the wider band. Entropy grows with
length, so its band is on what is left after a line fitted to the logarithm of
the token count.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import byte_bpe
from quire.llm import common as C

PIECES = "piece_bpe_32k.model"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CACHED_WORDS, CACHED_PIECES = 200_000, 60_000
# Width of the bands in robust standard deviations (IQR / 1.349), the least
# deviation taken, and the documents that the wider group counts for in a
# language's or script's band. WHOLE names the corpus's band.
CHARS_BAND, ENTROPY_BAND, FALLBACK_BAND = 8.0, 6.0, 10.0
LEAST_SD = {"chars_per_token": 0.02, "fallback_share": 0.01, "entropy_rest": 0.05}
PRIOR_DOCS = 50
WHOLE = "all"
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Thai", "Han", "Hiragana", "Katakana", "Hangul")
_SCHEMA = ("doc_id long, band string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, n_tokens long, chars_per_token double, fallback_share double, entropy double")


class Meter:
    """Per-word token ids and piece counts of the vocabularies, each distinct word once."""

    def __init__(self, bpe_path: str, pattern: str, piece_path: str):
        import sentencepiece

        self.bpe = byte_bpe.ByteBpe(bpe_path, pattern, CACHED_PIECES)
        self.sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.vocab_size())], bool)
        self.known, self.table = {}, _no_words()          # word -> its place in the table
        self.old, self.old_table = {}, _no_words()

    @C.no_gc()
    def learn(self, words: set[bytes]) -> None:
        """Puts the words into the table. It holds ``CACHED_WORDS`` words or
        those of one batch; a full one becomes the old one, from which words
        that come again move back, so frequent words stay."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.old, self.old_table, self.known, self.table, new = self.known, self.table, {}, _no_words(), words
        fresh = list(new.difference(self.old))
        again = list(new.difference(fresh))
        sizes, pieces, in_bytes, pool = self.old_table
        at = np.fromiter(map(self.old.__getitem__, again), np.int64, len(again))
        tables = [self.table, (sizes[at], pieces[at], in_bytes[at], pool[C.ranges((np.cumsum(sizes) - sizes)[at], sizes[at])])]
        if fresh:
            tables.append(self._table(fresh))
        self.known.update(zip(itertools.chain(again, fresh), range(len(self.known), len(self.known) + len(new)), strict=True))
        self.table = tuple(map(np.concatenate, zip(*tables, strict=True)))

    def _table(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Tokens, pieces and byte pieces of each word, and its token ids one word after another."""
        strs = [w.decode("utf-8") for w in words]
        pieces = self.sp.encode(strs, num_threads=1)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flags = self.is_byte[np.fromiter(itertools.chain.from_iterable(pieces), np.int64, int(sizes.sum()))]
        ends = np.cumsum(sizes)
        upto = np.concatenate(([0], np.cumsum(flags)))
        own = self._token_ids(strs)
        return np.fromiter(map(len, own), np.int64, len(own)) // 4, sizes, upto[ends] - upto[ends - sizes], np.frombuffer(b"".join(own), "<u4")

    def _token_ids(self, strs: list[str]) -> list[bytes]:
        """Byte-BPE ids of each word behind one blank. Words without white
        space run as one text: there every word's first piece, and no other,
        starts with the blank."""
        plain = [k for k, s in enumerate(strs) if s.isascii() or not any(map(str.isspace, s))]
        out = [b""] * len(strs)
        if plain:
            pieces = self.bpe.pieces_of(" " + " ".join([strs[k] for k in plain]))
            self.bpe.learn(set(pieces))
            ids = list(map(self.bpe.known.__getitem__, pieces))
            first = [i for i, p in enumerate(pieces) if p[0] == " "] + [len(pieces)]
            for k, i, j in zip(plain, first, first[1:], strict=False):
                out[k] = ids[i] if j == i + 1 else b"".join(ids[i:j])
        rest = sorted(set(range(len(strs))).difference(plain))
        for k, own in zip(rest, self.bpe.encode([" " + strs[k] for k in rest]), strict=True):
            out[k] = own
        return out

    def measures(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, share of byte pieces and entropy of every document of a
        batch: ``codes`` are the places of its words, documents end at ``ends``."""
        docs = len(ends)
        size, pieces, byte_pieces, pool = self.table
        first = np.cumsum(size) - size
        doc = np.repeat(np.arange(docs), np.diff(ends, prepend=0))
        n_tokens = np.bincount(doc, size[codes], docs).astype(np.int64)
        per = [np.bincount(doc, x[codes], docs) for x in (pieces, byte_pieces)]
        # every token of the batch as (document, id), sorted once
        count = size[codes]
        keys = np.sort((np.repeat(doc, count) << 32) | pool[C.ranges(first[codes], count)].astype(np.int64))
        runs = np.flatnonzero(np.concatenate((keys[:1] >= 0, keys[1:] != keys[:-1])))
        of = (keys[runs] >> 32).astype(np.int64)
        share = np.diff(runs, append=len(keys)) / n_tokens[of]
        entropy = -np.bincount(of, share * np.log2(share), docs)
        return n_tokens, per[1] / np.maximum(1, per[0]), np.abs(entropy)


def _no_words() -> tuple[np.ndarray, ...]:
    return (*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, "<u4"))


def meter(bpe_path: str, pattern: str, piece_path: str) -> Meter:
    return C.one_model(("meter", bpe_path, pattern, piece_path), lambda: Meter(bpe_path, pattern, piece_path))


def repeat_words(codes: np.ndarray, ends: np.ndarray, span: int = 3) -> np.ndarray:
    """Per document: words inside a ``span``-word window that occurs at least
    twice in its text; ``codes`` number the words, documents end at ``ends``."""
    docs, n = len(ends), len(codes) - span + 1
    doc = np.repeat(np.arange(docs), np.diff(ends, prepend=0))
    if n < 2:
        return np.zeros(docs, np.int64)
    inside = np.flatnonzero(doc[:n] == doc[span - 1:])
    base = int(codes.max()) + 1
    window, most = doc[inside], docs
    for k in range(span):
        if most * base >= 2 ** 62:
            window = np.unique(window, return_inverse=True)[1]
            most = len(window)
        window, most = window * base + codes[inside + k], most * base
    ordered = np.sort(window)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(codes), bool)
    if len(twice):
        hit = inside[twice[np.minimum(np.searchsorted(twice, window), len(twice) - 1)] == window]
        for k in range(span):
            covered[hit + k] = True
    return np.bincount(doc[covered], minlength=docs)


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            if line in seen:
                dup += 1
            seen.add(line)
    return dup


@functools.cache
def _script_table() -> np.ndarray:
    """Number of each code point's script in ``SCRIPTS``, their count for all others."""
    table = np.full(0x110000, len(SCRIPTS), np.uint8)
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    for k, s in enumerate(SCRIPTS):
        own = "".join(regex.findall(rf"\p{{Script={s}}}+", every))
        table[np.frombuffer(own.encode("utf-32-le"), "<u4")] = k
    return table


def script_of(text: str) -> str:
    """Script of most of the text's letters; ties go to the first of ``SCRIPTS``."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(_script_table()[codes], minlength=len(SCRIPTS) + 1)[:-1]
    return SCRIPTS[int(counts.argmax())] if counts.any() else "none"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
             folder: str | None = None) -> DataFrame:
    """Base counts and vocabulary measures, one row per input row."""
    C.prepare(docs.sparkSession)
    bpe_path, pattern = byte_bpe._parts(byte_bpe.VOCAB, folder, None)
    piece_path = C.tokenizer_file(PIECES, folder)
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    kind = C.id_type(id_col)
    own = docs.select(F.col(f"`{id_col}`").cast(kind).alias("doc_id"), F.col(f"`{text_col}`").alias("text"), lang.alias("lang"))

    def run(batches):
        m = meter(bpe_path, pattern, piece_path)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            split = [t.encode("utf-8").split() for t in texts]
            m.learn(set(itertools.chain.from_iterable(split)))
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            codes = np.fromiter(map(m.known.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
            ends = np.cumsum(sizes)
            del split
            n_tokens, fallback, entropy = m.measures(codes, ends)
            present = np.zeros(len(m.known), bool)
            present[codes] = True
            repeated = repeat_words((np.cumsum(present) - 1)[codes], ends)     # numbered without gaps
            rows = []
            for k, (doc_id, text, lang) in enumerate(zip(pdf["doc_id"], texts, pdf["lang"], strict=True)):
                chars = len(text) - sum(map(text.count, BLANKS))
                script = script_of(text)
                n = int(n_tokens[k])
                rows.append((doc_id, f"lang:{lang}" if isinstance(lang, str) else f"script:{script}", script, int(sizes[k]), chars,
                             sum(map(text.count, SYMBOLS)), dup_lines(text), int(repeated[k]), n, chars / n if n else 0.0,
                             float(fallback[k]), float(entropy[k])))
            out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _SCHEMA.split(", ")])
            yield out.astype({"doc_id": "Int64"}) if kind == "long" else out
        pdf = texts = codes = rows = out = None      # gone before the worker waits for its next task
        C.give_back()

    return own.mapInPandas(run, _SCHEMA.replace("doc_id long", f"doc_id {kind}"))


def _entropy_rest():
    return F.col("entropy") - F.coalesce(F.col("slope") * F.log2("n_tokens") + F.col("offset"), F.col("entropy"))


def _levels():
    """The groups a document's band is made from: its language (or script),
    its script over all languages, the corpus."""
    whole = F.concat(F.lit(WHOLE), F.substring("script", 1, 0))      # a column, so that joins on it stay hash joins
    return F.array("band", F.concat(F.lit(f"{WHOLE}:"), "script"), whole)


def bands(passing: DataFrame) -> DataFrame:
    """Per group (``band``): documents, fitted entropy line, median and
    deviation of each measure. A group's figures count as its documents, next
    to ``PRIOR_DOCS`` documents' worth of the wider group's, so that a few
    documents say little and a language with many speaks for itself."""
    line = passing.groupBy("band").agg(F.count(F.lit(1)).alias("docs"), F.regr_slope("entropy", F.log2("n_tokens")).alias("slope"),
                                       F.regr_intercept("entropy", F.log2("n_tokens")).alias("offset"))
    # one row a group: no shuffle by group, of which one may hold most rows
    rest = passing.join(C.small(C.stored(line, "fertility-lines")), "band").withColumn("entropy_rest", _entropy_rest())
    aggs = []
    for c in LEAST_SD:
        q = F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
        aggs += [q[1].alias(f"{c}_mid"), F.greatest((q[2] - q[0]) / 1.349, F.lit(LEAST_SD[c])).alias(f"{c}_sd")]
    return rest.groupBy("band").agg(*aggs).join(line, "band")


FIGURES = ["slope", "offset", *[f"{c}_{x}" for c in LEAST_SD for x in ("mid", "sd")]]


def _blended(m: DataFrame, passing: DataFrame) -> DataFrame:
    """(band, script) -> the figures its documents are judged by: those of the
    corpus, drawn towards the script's and then the language's by their documents."""
    of = C.stored(bands(passing.withColumn("band", F.explode(_levels()))), "fertility-bands")
    pairs = m.select("band", "script").distinct()
    out = pairs
    for k, name in ((2, "w"), (1, "s"), (0, "l")):
        own = of.select(F.col("band").alias("_use"), F.col("docs").alias(f"{name}_docs"), *[F.col(c).alias(f"{name}_{c}") for c in FIGURES])
        out = out.withColumn("_use", _levels()[k]).join(own, "_use", "left").drop("_use")

    def drawn(base, name, c):
        n = F.coalesce(f"{name}_docs", F.lit(0))
        return (F.coalesce(f"{name}_{c}", base) * n + base * PRIOR_DOCS) / (n + PRIOR_DOCS)

    figures = [drawn(drawn(F.col(f"w_{c}"), "s", c), "l", c).alias(c) for c in FIGURES]
    return C.stored(out.select("band", "script", *figures), "fertility-chosen")


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
          folder: str | None = None) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the measures; one row per input row.

    Null and empty texts have no words and fail the base rules. Without a
    language (null, or no such column) the band is that of the text's main
    script. Every document that passes the base rules is judged. Repeated rows
    are judged alike; a null doc_id stays null; other columns are not read. An
    empty table gives no rows.
    """
    m = measured(docs, id_col, text_col, lang_col, folder)
    m = C.stored(m.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))),
                 "fertility")
    passing = m.where(~F.col("base_failed"))
    out = m.join(C.small(_blended(m, passing)), ["band", "script"], "left")
    low = F.col("chars_per_token") < F.col("chars_per_token_mid") - CHARS_BAND * F.col("chars_per_token_sd")
    high = F.col("chars_per_token") > F.col("chars_per_token_mid") + CHARS_BAND * F.col("chars_per_token_sd")
    bytes_ = F.col("fallback_share") > F.col("fallback_share_mid") + FALLBACK_BAND * F.col("fallback_share_sd")
    dull = _entropy_rest() < F.col("entropy_rest_mid") - ENTROPY_BAND * F.col("entropy_rest_sd")
    reject = F.coalesce(low | high | bytes_ | dull, F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~reject).alias("kept"), "n_tokens", "chars_per_token", "fallback_share", "entropy", "band")


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
                  folder: str | None = None, by_row: bool = False) -> DataFrame:
    """``docs`` without the documents the rules reject; all columns as they
    were. A doc_id goes if any of its rows is rejected; rows without id stay.
    With ``by_row`` every row goes or stays by its own verdict, with or without id."""
    if by_row:
        return C.by_row(docs, id_col, text_col, lambda d, key: drop_rejected(d, key, text_col, lang_col, folder))
    found = C.stored(rules(docs, id_col, text_col, lang_col, folder).select("doc_id", "kept"), "fertility-verdicts")
    return C.without_ids(docs, id_col, found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
