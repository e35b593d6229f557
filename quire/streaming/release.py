"""Ordered release across micro-batches (T4).

Article responses of a listing page arrive in any order; an item is released
only when every earlier slot of its page is filled. In a stream the slots of
a page can be split over micro-batches, so the responses still waiting
behind an empty slot are kept as a versioned *pending* table: batch ``n``
unions the pending rows of version ``n-1`` with its own responses, releases
what it can (W2/W3) and writes the rest as pending version ``n``. Released
items are appended per batch (overwrite of ``items/batch=n``: a replayed
batch rewrites the same rows and reads the same pending version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.sinks.tables import VersionedTable
from quire.sources.extractors import conditions_release


class ReleaseStores:
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.pending = VersionedTable(f"{self.root}/pending")
        self.marks = VersionedTable(f"{self.root}/released")
        self.items = f"{self.root}/items"
        self.rejects = f"{self.root}/rejects"
        self.checkpoint = f"{self.root}/_checkpoint"


def process_batch(batch: DataFrame, batch_id: int, stores: ReleaseStores, source_id: str) -> None:
    """One micro-batch: pending rows of the previous batch + new responses,
    positions shifted past the slots each page has already released."""
    spark = batch.sparkSession
    cols = batch.columns
    prior = stores.pending.read(spark, before=batch_id)
    marks = stores.marks.read(spark, before=batch_id)
    rows = batch if prior is None else batch.unionByName(prior.select(*cols))
    if marks is None:
        marks = spark.createDataFrame([], "page_no long, released_upto long")
    j = rows.join(marks, "page_no", "left").withColumn("_base", F.coalesce("released_upto", F.lit(-1)) + 1)
    passed = F.coalesce((F.col("position") >= 0) & (F.col("position") < F.col("_base")), F.lit(False))
    late = j.where(passed)
    fresh = j.where(~passed).withColumn("position", F.col("position") - F.col("_base"))
    rel = conditions_release(fresh.drop("released_upto"), source_id)
    base = marks.select("page_no", (F.col("released_upto") + 1).alias("_base"))
    late_rejects = late.select(F.lit(source_id).alias("source_id"), "url", F.lit("extract").alias("stage"),
                               F.lit("slot already released").alias("reason"))
    # seq continues across batches: the batch id in the high bits keeps arrival order
    (rel.items.drop("page_no", "position", "_base")
     .withColumn("seq", F.col("seq") + F.lit(batch_id).cast("long") * (1 << 32))
     .write.mode("overwrite").parquet(f"{stores.items}/batch={batch_id}"))
    rel.rejects.unionByName(late_rejects).write.mode("overwrite").parquet(f"{stores.rejects}/batch={batch_id}")
    pend = (rel.pending.withColumn("position", F.col("position") + F.col("_base")).select(*cols))
    stores.pending.write(pend, batch_id)
    upto = (rel.released.join(base, "page_no", "left")
            .select("page_no", (F.col("released_upto") + F.coalesce("_base", F.lit(0))).alias("released_upto")))
    merged = marks.unionByName(upto).groupBy("page_no").agg(F.max("released_upto").alias("released_upto"))
    stores.marks.write(merged, batch_id)


def run(spark: SparkSession, source_dir: str, schema: StructType, stores: ReleaseStores, *,
        source_id: str = "conditions", max_files_per_trigger: int = 1, fmt: str = "json"):
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    q = (stream.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, stores, source_id))
         .option("checkpointLocation", stores.checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
