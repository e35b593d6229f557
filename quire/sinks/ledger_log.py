"""The ledger as a base snapshot plus per-batch deltas (K1 at scale).

Rewriting the whole ledger for every batch costs a full scan and a full
write per batch. Here a batch writes only its *delta* - the new state of the
URLs it touched (one row per URL) - to ``delta/batch=n``. The current row of
a URL is its row in the newest delta that has it, else its base row:

* the base is partitioned by a hash bucket of the URL: a batch reads the
  buckets its URLs fall into and no others (a partition filter), semi-joins
  them with its URL set (broadcast when its size is proven small, behind a
  Bloom filter otherwise) and reduces to the newest row per URL. The number of
  buckets follows the size of the ledger and is part of the table's folders;
  a bucket is written by as many tasks as its rows need;
* deltas are plain files of the batch's own size;
* ``compact(n)`` folds base + deltas up to ``n`` into base version ``n``
  (one shuffle, run on a schedule - not per batch), and removes what the base
  before it had already folded - a replay of batch ``n`` still finds its input;
* the whole state (for high-water marks or export) is the same reduction
  over everything.

Writes are idempotent: a replayed batch overwrites its own delta, and reads
for batch ``n`` ignore deltas ``>= n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import keyed_filter
from quire.sinks.files import finished_folders, folder_names, remove_folder
from quire.sinks.tables import VersionedTable

LEDGER_COLUMNS = ["source_id", "url", "modified_at"]
MAX_BROADCAST_BATCH_URLS = 100_000


# Hash buckets of a small base; one with more rows than this per bucket takes
# more (a power of two).
BUCKETS = 64
BUCKET_ROWS = 4_000_000
# Rows of one file, and so of one task that writes it.
FILE_ROWS = 2_000_000


class LedgerLog:
    def __init__(self, path: str, buckets: int = BUCKETS):
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.base = VersionedTable(f"{self.path}/base")
        self.delta_path = f"{self.path}/delta"

    @staticmethod
    def _bucket(url: str, buckets: int):
        return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")

    def _deltas(self, spark: SparkSession, after: int, before: int | None) -> DataFrame | None:
        keep = [b for b in finished_folders(spark, self.delta_path, "batch=") if b > after and (before is None or b < before)]
        if not keep:
            return None
        paths = [f"{self.delta_path}/batch={b}" for b in keep]
        return (spark.read.option("basePath", self.delta_path).parquet(*paths)
                .select(*LEDGER_COLUMNS, F.col("batch").cast("long").alias("_ver")))

    def _parts(self, spark: SparkSession, before: int | None, urls: DataFrame | None = None) -> DataFrame | None:
        """Base and delta rows as seen by batch ``before``; with ``urls`` only
        the base buckets these fall into."""
        bases = [v for v in self.base.versions(spark) if before is None or v < before]
        parts = []
        if bases:
            rows = self.base.read(spark, before=bases[-1] + 1)
            if urls is not None:
                n = int(folder_names(spark, f"{self.base.path}/v={bases[-1]}")[0].split("=")[1])
                # at most one number per bucket: the partition filter of the base
                hit = [r[0] for r in urls.select(self._bucket("url", n)).distinct().collect()]
                rows = rows.where(F.col("bucket").isin(hit))
            parts.append(rows.select(*LEDGER_COLUMNS, F.lit(-1).cast("long").alias("_ver")))
        d = self._deltas(spark, bases[-1] if bases else -1, before)
        if d is not None:
            parts.append(d)
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        return (rows.groupBy("url").agg(F.max_by(F.struct("source_id", "modified_at"), "_ver").alias("s"))
                .select(F.col("s.source_id").alias("source_id"), "url", F.col("s.modified_at").alias("modified_at")))

    def rows_for(self, spark: SparkSession, urls: DataFrame, before: int | None = None) -> DataFrame | None:
        """Current ledger rows of the given URLs (``urls(url)``) as seen by batch ``before``."""
        urls = urls.select("url").where("url IS NOT NULL").distinct()
        parts = self._parts(spark, before, urls)
        return None if parts is None else self._newest(keyed_filter(parts, urls, "url", "left_semi", MAX_BROADCAST_BATCH_URLS))

    def state(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The whole ledger (one row per URL)."""
        parts = self._parts(spark, before)
        return None if parts is None else self._newest(parts)

    def _laid_out(self, rows: DataFrame, n: int) -> DataFrame:
        """Rows with their bucket; a bucket's rows are dealt to as many tasks
        as ``n`` rows in all make files."""
        buckets = self.buckets
        while n > buckets * BUCKET_ROWS:
            buckets *= 2
        shares = max(1, -(-n // (buckets * FILE_ROWS)))
        share = F.pmod(F.xxhash64("url", F.lit("share")), F.lit(shares))
        return (rows.select(*LEDGER_COLUMNS, F.lit(buckets).alias("buckets"), self._bucket("url", buckets).alias("bucket"))
                .repartition("bucket", share))

    def append_delta(self, delta: DataFrame, batch_id: int) -> None:
        (delta.select(*LEDGER_COLUMNS).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
         .parquet(f"{self.delta_path}/batch={batch_id}"))

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold base + deltas ``<= upto`` into base version ``upto``; what was
        folded into the base before this one is removed."""
        parts = self._parts(spark, upto + 1)
        rows = parts.count() if parts is not None else 0
        if not rows:
            return
        state = self._newest(parts)
        older = [v for v in self.base.versions(spark) if v < upto]
        self.base.write(self._laid_out(state, rows), upto, partition_by=["buckets", "bucket"], sort_within=["source_id", "modified_at"])
        if older:
            self.base.remove_before(spark, older[-1])
            for b in finished_folders(spark, self.delta_path, "batch="):
                if b <= older[-1]:
                    remove_folder(spark, f"{self.delta_path}/batch={b}")
