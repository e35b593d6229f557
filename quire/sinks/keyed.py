"""Tables laid out by key (K3, K4): bucketed and sorted, joined without a shuffle.

A version of a table is a folder of bucket files that the session's catalog
knows as a bucketed table. Tables with the same number of buckets over the
same key join bucket by bucket: neither side goes through an exchange. An
update reads the old version, drops the touched keys bucket by bucket and
writes the next version; only the batch is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import dictionary as dct

BUCKETS = 16
SOURCE = ["src_item_type", "src_item_id"]
TARGET = ["dst_item_type", "dst_item_id"]


class KeyedTable:
    def __init__(self, path: str, key: list[str], buckets: int = BUCKETS):
        self.path, self.key, self.buckets = path.rstrip("/"), key, buckets
        self.prefix = f"keyed_{uuid.uuid4().hex}"

    def write(self, df: DataFrame, version: int) -> None:
        """``df`` as the table's version; rows that already lie by key stay where they are."""
        (df.repartition(self.buckets, *self.key).write.mode("overwrite").bucketBy(self.buckets, *self.key).sortBy(*self.key)
         .option("path", f"{self.path}/v={version}").saveAsTable(f"{self.prefix}_{version}"))

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.table(f"{self.prefix}_{version}")


class DictionaryStore:
    """The dictionary by item, its links by source and once more by target."""

    def __init__(self, root: str, buckets: int = BUCKETS):
        self.items = KeyedTable(f"{root}/items", dct.KEY, buckets)
        self.links = KeyedTable(f"{root}/links", SOURCE, buckets)
        self.targets = KeyedTable(f"{root}/targets", TARGET, buckets)

    def update(self, spark: SparkSession, version: int, items: DataFrame, touched: DataFrame, links: DataFrame) -> None:
        """U2, U3 and the cascade of J6: upsert ``items`` (with ``seq``), replace
        the links of the ``touched`` sources by ``links``, and keep links by
        target only where their source exists."""
        old = (self.items.read(spark, version - 1), self.links.read(spark, version - 1)) if version else (None, None)
        self.items.write(dct.upsert(old[0], items), version)
        self.links.write(dct.replace_edges(old[1], touched, links), version)
        held = dct.links_with_source(self.links.read(spark, version), self.items.read(spark, version))
        self.targets.write(held.select(*dct.EDGE_COLUMNS), version)

    def resolved(self, spark: SparkSession, version: int) -> DataFrame:
        """Every link of an existing source with its target's name."""
        names = self.items.read(spark, version).select(
            F.col("item_type").alias("dst_item_type"), F.col("item_id").alias("dst_item_id"), F.col("name").alias("dst_name"), F.lit(True).alias("resolved"))
        return (self.targets.read(spark, version).join(names, TARGET, "left").withColumn("resolved", F.coalesce("resolved", F.lit(False))))
