"""Stand-off export (K6, F19): one text file and one empty ``.ann`` file per
document, written by the executors straight into a shared folder.

Each task writes the files of its own rows and returns manifest rows, so
nothing passes through the driver. File names are a function of the row,
so a retried task rewrites the same files (idempotent under executor loss).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import bounded_batches
from quire.sinks.files import qualified

MANIFEST = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def export_name(source_id: Column, run_ts: Column, doc_id: Column, text: Column) -> Column:
    """``{source_id}_{yyyyMMddHHmmss}_{stable hash}`` (the random part of
    a temporary file name is replaced by a hash of the document)."""
    return F.concat_ws("_", source_id, F.date_format(run_ts, "yyyyMMddHHmmss"),
                       F.substring(F.md5(F.concat(doc_id.cast("string"), F.coalesce(text, F.lit("")))), 1, 12))


def _writer(target: str):
    def write(batches):
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(target)
        filesystem.create_dir(base, recursive=True)
        for pdf in batches:
            for name, text in zip(pdf["file_name"], pdf["text"]):
                with filesystem.open_output_stream(f"{base}/{name}.txt") as f:
                    f.write((text or "").encode("utf-8"))
                with filesystem.open_output_stream(f"{base}/{name}.ann") as f:
                    f.write(b"")
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("int64"), "file_name": pdf["file_name"],
                                "n_chars": pdf["text"].fillna("").str.len().astype("int64")})
    return write


def export(docs: DataFrame, target: str, *, run_ts: Column, source_col: str = "source_id",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files under ``target`` (a shared path or URI) and return
    the manifest ``(doc_id, file_name, n_chars)``."""
    bounded_batches(docs.sparkSession)
    target = qualified(docs.sparkSession, target)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        export_name(F.col(source_col), run_ts, F.col(id_col), F.col(text_col)).alias("file_name"))
    return named.mapInPandas(_writer(target), MANIFEST)
