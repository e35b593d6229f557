"""Stand-in feeds derived from the driver tables.

Each feed is given twice: as a Spark DataFrame builder and as the DuckDB SQL
of the same rows (a CTE body), so every named query has an oracle over the
same input. All derivations are per-row expressions over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from quire.session import ship_package

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- events as an item feed -------------------------------------------------
# url = u/<user>/<type>; time = day of ts, null for every 17th event;
# source = event type; arrival order = event id.

def events_feed(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.lit("text").alias("kind"),
        F.col("event_type").alias("source_id"),
        F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type")).alias("source_url"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None))
         .otherwise(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")).alias("modified_at"),
        F.col("ts"), F.col("value"), F.col("props"))


EVENTS_FEED_SQL = """
SELECT event_id AS seq, 'text' AS kind, event_type AS source_id,
       'u/' || CAST(user_id AS VARCHAR) || '/' || event_type AS source_url,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE date_trunc('day', ts) END AS modified_at,
       ts, value, props
FROM events"""


def events_midpoint(e: DataFrame) -> DataFrame:
    """One-row frame with the midpoint of the event time range."""
    return e.agg(F.timestamp_add("SECOND",
                                ((F.unix_micros(F.max("ts").cast("timestamp")) -
                                  F.unix_micros(F.min("ts").cast("timestamp"))) / 2_000_000).cast("long"),
                                F.min("ts")).alias("mid"))


MIDPOINT_SQL = """
SELECT min(ts) + to_seconds(CAST(trunc((epoch_us(max(ts)) - epoch_us(min(ts))) / 2000000) AS BIGINT)) AS mid
FROM events"""


def split_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Events feed split at the midpoint of its time range (batch 1, batch 2)."""
    feed = events_feed(spark, sf_dir)
    mid = events_midpoint(table(spark, sf_dir, "events")).scalar()  # scalar subquery
    return feed.where(F.col("ts") < mid), feed.where(F.col("ts") >= mid)


# --- pages as an html feed --------------------------------------------------

HOST_PATTERN = r"^[a-zA-Z]+://([^/?#]+)"


def pages_feed(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").alias("seq"),
        F.lit("html").alias("kind"),
        F.regexp_extract("url", HOST_PATTERN, 1).alias("source_id"),
        F.col("url").alias("source_url"),
        F.lit(None).cast("timestamp_ntz").alias("modified_at"),
        F.col("html"))


PAGES_FEED_SQL = f"""
SELECT page_id AS seq, 'html' AS kind, regexp_extract(url, '{HOST_PATTERN}', 1) AS source_id,
       url AS source_url, CAST(NULL AS TIMESTAMP) AS modified_at, html
FROM pages"""


def routes_for(sources: DataFrame) -> DataFrame:
    """Routes of the stand-in sources: stable ids from the source name."""
    return sources.select("source_id").distinct().select(
        "source_id",
        F.conv(F.substring(F.md5("source_id"), 1, 6), 16, 10).cast("long").alias("project_id"),
        F.conv(F.substring(F.md5("source_id"), 7, 4), 16, 10).cast("long").alias("dataset_id"))


def routes_sql(src: str) -> str:
    return f"""
SELECT source_id,
       CAST(('0x' || substr(md5(source_id), 1, 6)) AS BIGINT) AS project_id,
       CAST(('0x' || substr(md5(source_id), 7, 4)) AS BIGINT) AS dataset_id
FROM (SELECT DISTINCT source_id FROM {src})"""
