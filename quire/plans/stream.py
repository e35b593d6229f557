"""Named query: the events feed through the streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.plans import standins as S
from quire.plans.corpus import ledger_accept_sql
from quire.plans.registry import query
from quire.session import scratch_path
from quire.streaming import ingest as si

CHUNKS = 4
# Files of one micro-batch; a scheduled run takes all that landed.
MAX_FILES = 1_000_000


@query("stream_ingest", sql=f"""
WITH a AS ({ledger_accept_sql(S.EVENTS_FEED_SQL)}), f AS ({S.EVENTS_FEED_SQL}), r AS ({S.routes_sql('f')})
SELECT 'accepted' AS outcome, seq, source_id, source_url AS url, modified_at, CAST(NULL AS BIGINT) AS project_id, CAST(1 AS BIGINT) AS n FROM a
UNION ALL SELECT 'document', NULL, a.source_id, a.source_url, NULL, r.project_id, count(*) FROM a JOIN r USING (source_id) GROUP BY ALL
UNION ALL SELECT 'unchanged', NULL, source_id, source_url, NULL, NULL, count(*) FROM f WHERE seq NOT IN (SELECT seq FROM a) GROUP BY ALL""")
def stream_ingest(spark, sf_dir):
    """The events feed lands in a folder in four
    arrival chunks; after each a scheduled AvailableNow run ingests what is
    new, the last chunk's batch twice (a replay). Accepted items, stored
    documents and rejects of the four batches equal the one-batch run."""
    feed = S.events_feed(spark, sf_dir).select("seq", "kind", "source_id", "source_url", "modified_at",
                                               F.coalesce("props", F.lit("")).alias("text"))
    root = scratch_path(spark, "stream")
    src, stores, routes = f"{root}/feed", si.StreamStores(root, buckets=8), S.routes_for(feed)
    lo = feed.agg(F.min("seq")).scalar()
    span = feed.agg(F.max("seq") - F.min("seq") + 1).scalar()
    chunked = feed.withColumn("_chunk", F.floor((F.col("seq") - lo) * CHUNKS / span))
    options = {"routes": routes, "run_ts": F.lit(None).cast("timestamp"), "trainer": False}
    for k in range(CHUNKS):
        chunk = chunked.where(F.col("_chunk") == k).drop("_chunk")
        chunk.write.mode("append").parquet(src)
        si.run(spark, src, feed.schema, stores, max_files_per_trigger=MAX_FILES, **options)
    si.process_batch(chunk, CHUNKS - 1, stores, **options)
    none = F.lit(None)
    accepted = si.read_target(spark, stores, "accepted").select(
        F.lit("accepted").alias("outcome"), "seq", "source_id", F.col("source_url").alias("url"), "modified_at",
        none.cast("long").alias("project_id"), F.lit(1).cast("long").alias("n"))
    docs = si.read_target(spark, stores, "documents").select(F.lit("document").alias("outcome"), "source_id",
                                                             F.col("source_url").alias("url"), "project_id")
    rejects = si.read_target(spark, stores, "rejects").select(F.col("reason").alias("outcome"), "source_id", "url",
                                                              none.cast("long").alias("project_id"))
    counted = docs.unionByName(rejects).groupBy("outcome", "source_id", "url", "project_id").agg(F.count(F.lit(1)).alias("n"))
    return accepted.unionByName(counted.withColumn("seq", none.cast("long")).withColumn("modified_at", none.cast("timestamp_ntz")))
