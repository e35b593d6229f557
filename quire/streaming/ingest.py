"""Streaming ingest (T1, T2, T7): the whole ingest job per micro-batch.

``readStream`` over an item folder, ``foreachBatch`` runs C1 on each
micro-batch against the ledger as it stood before the batch: rejects (P2,
P13), documents, dictionary items, links, trainer and passthrough rows of
batch ``n`` go to ``{target}/batch=n/attempt=..``, then the ledger change of
batch ``n`` is written, and last of all a commit record that names the folders
(T7, :mod:`quire.sinks.commits`). Readers see committed batches only. A batch
that is re-run after a failure reads the ledger from *before* it, so it
decides exactly as the first attempt did.

Ledger layouts: ``"log"`` (default) keeps a base snapshot plus one delta
per batch (:mod:`quire.sinks.ledger_log`): a batch reads only its URLs' rows
and writes only its delta, and every ``compact_every`` batches the deltas
are folded into a new base. ``"versions"`` writes the whole ledger per
batch (simple, for small ledgers).

``Trigger.AvailableNow`` makes the same job an incremental batch run on a
schedule (T1, T6): each run takes only the files the source checkpoint has
not seen.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.operators import ingest as ing
from quire.sinks import files
from quire.sinks.commits import CommitLog
from quire.sinks.ledger_log import BUCKETS, LedgerLog
from quire.sinks.tables import VersionedTable, write_ledger

COMPACT_EVERY = 8


@dataclass
class StreamStores:
    root: str
    buckets: int = BUCKETS

    def target(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def ledger(self) -> VersionedTable:
        return VersionedTable(f"{self.root}/ledger")

    @property
    def log(self) -> LedgerLog:
        return LedgerLog(f"{self.root}/ledger_log", self.buckets)

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.root}/commits")

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


# Targets of a batch, in the order they are written.
TARGETS = ["rejects", "passthrough", "documents", "dictionary", "links", "trainer", "accepted"]
ROUTES_SCHEMA = "source_id string, project_id long, dataset_id long"


def process_batch(batch: DataFrame, batch_id: int, stores: StreamStores, *, routes: DataFrame | None = None,
                  policy: str = "different", layout: str = "log", compact_every: int = COMPACT_EVERY,
                  trainer: bool = True, run_ts: Column | None = None) -> None:
    spark = batch.sparkSession
    if layout == "log":
        prior = stores.log.rows_for(spark, batch.select(F.col("source_url").alias("url")), before=batch_id)
    else:
        prior = stores.ledger.read(spark, before=batch_id)
    routes = routes if routes is not None else spark.createDataFrame([], ROUTES_SCHEMA)
    res = ing.ingest(batch, prior, routes, run_ts=run_ts, policy=policy, trainer=trainer, persist=True)
    accepted = res.decided.where("accepted").select("seq", "kind", "source_id", "source_url", "modified_at")
    attempt, written = uuid.uuid4().hex[:12], {}
    try:
        for name in TARGETS:
            rows = accepted if name == "accepted" else getattr(res, name)
            if rows is not None:
                written[name] = f"{stores.target(name)}/batch={batch_id}/attempt={attempt}"
                rows.write.parquet(written[name])
        if layout == "log":
            stores.log.append_delta(res.ledger_delta, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                stores.log.compact(spark, batch_id)
        else:
            write_ledger(stores.ledger, res.ledger, batch_id)
        stores.commits.write(spark, batch_id, written)
    finally:
        res.decided.unpersist()


def run(spark: SparkSession, source_dir: str, schema: StructType, stores: StreamStores, *,
        max_files_per_trigger: int = 1, fmt: str = "parquet", **batch_options):
    """Run the ingest stream until every available file is processed;
    ``batch_options`` go to :func:`process_batch`."""
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    q = (stream.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, stores, **batch_options))
         .option("checkpointLocation", stores.checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def read_target(spark: SparkSession, stores: StreamStores, name: str) -> DataFrame:
    """All committed batches of one target (column ``batch`` added)."""
    found = stores.commits.folders(spark, name)
    if not found:
        raise ValueError(f"no batch with target {name!r} has been committed")
    return spark.read.option("basePath", stores.target(name)).parquet(*found).drop("attempt")


def accepted_documents(spark: SparkSession, stores: StreamStores) -> DataFrame:
    """Keys of the accepted items."""
    return read_target(spark, stores, "accepted")


def ledger_state(spark: SparkSession, stores: StreamStores, layout: str = "log") -> DataFrame | None:
    """The ledger after the last committed batch."""
    last = stores.commits.last(spark)
    if last is None:
        return None
    return stores.log.state(spark, before=last + 1) if layout == "log" else stores.ledger.read(spark, before=last + 1)


def remove_uncommitted(spark: SparkSession, stores: StreamStores) -> int:
    """Delete the attempts that no commit record names (broken or replaced
    ones); not to be run while a batch is being written. Returns their number."""
    kept = {(t, b): folder.rsplit("=", 1)[1] for b, ts in stores.commits.records(spark).items() for t, folder in ts.items()}
    removed = 0
    for name in TARGETS:
        for batch in files.folder_names(spark, stores.target(name)):
            for attempt in files.folder_names(spark, f"{stores.target(name)}/{batch}"):
                if kept.get((name, int(batch.split("=")[1]))) != attempt.split("=")[1]:
                    files.remove_folder(spark, f"{stores.target(name)}/{batch}/{attempt}")
                    removed += 1
    return removed
