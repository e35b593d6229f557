"""File sources and sinks: CSV datasets (S6, N9, K10) and item feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire import schemas

# RFC 4180 style: quoted fields, doubled quotes, fields may span lines.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
# Writers trim whitespace by default; texts must round-trip unchanged.
CSV_WRITE_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false",
                     "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}


# A file whose fields span lines is read by one task, so files stay small.
CSV_FILE_ROWS = 50_000


def write_dataset_csv(df: DataFrame, path: str, file_rows: int = CSV_FILE_ROWS) -> None:
    """A dataset as CSV files of at most ``file_rows`` rows."""
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).option("maxRecordsPerFile", file_rows).csv(path)


def read_dataset_csv(spark: SparkSession, path: str, columns=("name", "text")) -> DataFrame:
    """Read a CSV dataset and keep only ``name`` and ``text`` (the other
    columns are never materialised: the CSV reader prunes them)."""
    return (spark.read.options(**CSV_OPTIONS, ignoreLeadingWhiteSpace="false",
                               ignoreTrailingWhiteSpace="false")
            .csv(path).select(*columns))


def read_items(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """An item feed with the fixed item schema (never inferred)."""
    return spark.read.schema(schemas.ITEMS).format(fmt).load(path)
