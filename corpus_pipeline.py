"""From raw documents to token ids, in five stages.

Each stage works on everything its predecessor kept, and its result is written
as Parquet and read again. All but the last return the columns of documents.

In every stage columns other than doc_id, text and lang pass unread, whatever
their names, and an empty table gives an empty table of the same columns. The
three filters judge rows (id and text), so rows without id are judged like all
others and rows that share an id go or stay one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import byte_bpe, decontaminate, fertility, line_dedup, near_dedup
from quire.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the vocabulary bands accept.

    Null and empty texts have no words and go. Repeated rows are judged alike;
    a null lang is judged by the text's script."""
    return fertility.drop_rejected(docs, by_row=True)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without passages that stand earlier in the corpus; n_chars follows the text.

    Every row stays: null texts as they are, and a text whose passages all
    stand elsewhere becomes empty. Rows that repeat id and text are one
    document and get one result; null ids come first in the corpus."""
    out = line_dedup.dedup_lines(docs, counts=False)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words, similarity 0.8.

    The smallest id stays, rows without id come behind all others and of their
    exact copies one stays. Null, empty and blank texts are like nothing and
    stay; rows that repeat id and text are one document."""
    return near_dedup.drop_near_duplicates(docs, by_row=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay; so does everything where the
    benchmark is empty. Repeated rows go or stay together."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), by_row=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and digests of the ids and of the text decoded from them.

    One row per document, null ids and repeated rows included; null and empty
    texts have no tokens. The ids are written before they are decoded: in one
    stage every task would hold a worker of each kind at once."""
    rows = byte_bpe.decode(stored(byte_bpe.encode(docs), "token-ids"))
    return rows.select("doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_chunks), ("near_dedup", near_duplicates),
          ("decontamination", decontamination), ("byte_bpe", token_ids)]

# Signatures, vocabularies and merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
