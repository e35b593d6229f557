"""Commit records (T7): what a batch wrote becomes visible at once.

A batch writes each target into a folder of its own attempt; the last thing it
does is to put one record in place that names them all, by an atomic rename.
Readers take their folders from the records, so they see whole batches only: a
batch that broke between two targets is invisible, and a replay shows either
the first attempt's rows in all targets or the second one's.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from quire.sinks import files

RECORDS = "batch long, targets map<string,string>"


class CommitLog:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, spark: SparkSession, batch: int, targets: dict[str, str]) -> None:
        """Commit ``batch``; ``targets`` maps each target to the folder of its
        rows. A record that is there already is replaced in one step."""
        files.write_text(spark, f"{self.path}/{batch}.json", json.dumps({"batch": batch, "targets": targets}))

    def records(self, spark: SparkSession, before: int | None = None) -> dict[int, dict[str, str]]:
        """Targets of every committed batch (before ``before``), by batch."""
        if not files.exists(spark, self.path):
            return {}
        rows = spark.read.schema(RECORDS).option("pathGlobFilter", "*.json").json(self.path).collect()
        return {r["batch"]: r["targets"] for r in sorted(rows, key=lambda r: r["batch"])
                if r["batch"] is not None and (before is None or r["batch"] < before)}

    def last(self, spark: SparkSession) -> int | None:
        return max(self.records(spark), default=None)

    def folders(self, spark: SparkSession, target: str, before: int | None = None) -> list[str]:
        """The committed folders of one target, in batch order."""
        return [t[target] for t in self.records(spark, before).values() if target in t]
