"""Dense sequential ids without a single-task global window (U5, U6 ids)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage


def sequential_ids(df: DataFrame, order: list[str], start: Column | int = 1,
                   id_col: str = "id", partitions: int | None = None) -> DataFrame:
    """Number the rows of ``df`` 0.. by ``order`` (which must be unique) and
    add ``start``.

    Range-partition by ``order`` (balanced by sampling) and sort within each
    range, number rows within each range, then shift each range by the row
    count of the ranges before it. Only one row per range partition - a
    proven bound - is combined in one place; the rows stay where they are.
    The ranged data is checkpointed so both passes see the same partitions.
    Without ``partitions`` the ranges follow the size of the data: AQE merges
    small neighbours, so a handful of rows is one range.
    """
    ranges = [partitions] if partitions else []
    ranged = cut_lineage(df.repartitionByRange(*ranges, *order).sortWithinPartitions(*order))
    # the checkpoint keeps partitions and their row order: the position inside
    # a partition is the low part of monotonically_increasing_id (no shuffle)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn(
        "_rn", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33) + 1)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).cast("long").alias("_off"))
    start_c = start if isinstance(start, Column) else F.lit(start)
    # one row per range partition: bounded by ``n`` by construction
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (F.col("_off") + F.col("_rn") - 1 + start_c).cast("long"))
            .drop("_pid", "_rn", "_off"))


def get_or_create(existing: DataFrame, requested: DataFrame, key: str,
                  id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Ids for requested names; unseen names get ``max(id) + 1..`` in
    name order. Returns ``(all_requested_with_ids, created)``."""
    req = requested.select(key).distinct()
    new = req.join(existing.select(key), key, "left_anti")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).scalar()
    created = sequential_ids(new, [key], start=top + F.lit(1), id_col=id_col)
    found = req.join(existing.select(key, id_col), key, "inner").withColumn("created", F.lit(False))
    return found.unionByName(created.withColumn("created", F.lit(True))), created.select(key, id_col)
