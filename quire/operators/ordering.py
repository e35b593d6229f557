"""Order-dependent operators: running aggregates per key, ordered release,
first-by-priority (W2, W3, O1, O2, O3).

:func:`running` is the skew-safe building block: a running max/min/sum/count
per key in ``order``. A per-key window would put a hot key's rows in one
task; instead rows are cut into chunks of the order value, each
``(key, chunk)`` is scanned by a window, and a tiny per-chunk total carries
the running value across chunks (a second window over one row per chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20

_AGG = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
# how chunk totals roll up across chunks, and how a carry joins a local value
_ROLL = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}


def _combine(op: str, local: Column, carry: Column) -> Column:
    if op == "max":
        return F.greatest(local, carry)
    if op == "min":
        return F.least(local, carry)
    return local + F.coalesce(carry, F.lit(0))


def running(df: DataFrame, key: list[str], order: str, values: dict[str, tuple[str, str]],
            chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Add running aggregates ``{out: (op, column)}`` per ``key`` in ``order``
    (inclusive of the current row). ``order`` must be numeric."""
    d = df.withColumn("_chunk", F.expr(f"`{order}` div {int(chunk)}"))
    w = (Window.partitionBy(*key, "_chunk").orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.select("*", *[_AGG[op](F.col(c)).over(w).alias(f"_l_{o}") for o, (op, c) in values.items()])
    totals = d.groupBy(*key, "_chunk").agg(*[_AGG[op](F.col(c)).alias(f"_t_{o}") for o, (op, c) in values.items()])
    wc = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*key, "_chunk", *[_ROLL[op](F.col(f"_t_{o}")).over(wc).alias(f"_c_{o}")
                                            for o, (op, _) in values.items()])
    j = local.join(carry, [*key, "_chunk"])
    for o, (op, _) in values.items():
        j = j.withColumn(o, _combine(op, F.col(f"_l_{o}"), F.col(f"_c_{o}")))
    return j.drop("_chunk", *[f"_l_{o}" for o in values], *[f"_c_{o}" for o in values])


def ordered_release(items: DataFrame, *, page: str = "page_no", position: str = "position",
                    arrival: str = "arrival", tie: list[str] | None = None,
                    chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """W2 + W3: items put into per-page slots by ``position`` in ``arrival``
    order are released in position order once every earlier slot is filled.

    Adds ``status`` ('released', 'pending' - waiting behind an empty slot -
    or 'rejected') and ``release_at`` (the arrival at which the item was
    released). Rejected are rows without a slot (null page, null or negative
    position) and all but one claimant of a slot: the earliest arrival fills
    it (none counts as latest), of equal arrivals the one with the smaller
    ``tie`` columns, then with the smaller content hash; of identical rows,
    one. Every input row comes out once.
    """
    cols = items.columns
    plain = [c for c, t in items.dtypes if "map<" not in t and "variant" not in t]
    rank = F.struct(F.col(arrival).isNull(), F.col(arrival), *[F.col(c) for c in tie or []], F.xxhash64(*plain))
    slotted = F.col(page).isNotNull() & F.coalesce(F.col(position) >= 0, F.lit(False))
    ranked = items.where(slotted).withColumn("_rank", rank)
    first = (ranked.groupBy(F.col(page).alias("_page"), F.col(position).alias("_slot"), "_rank").agg(F.count(F.lit(1)).alias("_copies"))
             .groupBy("_page", "_slot").agg(F.min(F.struct("_rank", "_copies")).alias("_first")))
    tagged = (ranked.join(first, (F.col(page) == F.col("_page")) & (F.col(position) == F.col("_slot")))
              .select(*cols, (F.col("_rank") == F.col("_first._rank")).alias("_won"), F.col("_first._copies").alias("_copies")))
    winners = tagged.where("_won")
    several = winners.where("_copies > 1").dropDuplicates([page, position])
    kept = winners.where("_copies = 1").select(*cols).unionByName(several.select(*cols))
    copies = several.withColumn("_copy", F.explode(F.sequence(F.lit(2), F.col("_copies").cast("int")))).select(*cols)
    rejected = (tagged.where("NOT _won").select(*cols).unionByName(copies).unionByName(items.where(~slotted))
                .withColumn("status", F.lit("rejected"))
                .withColumn("release_at", F.lit(None).cast("long")))
    r = running(kept, [page], position, {"_upto": ("max", arrival), "_n": ("count", position)}, chunk)
    complete = F.col("_n") == F.col(position) + 1
    out = (r.withColumn("status", F.when(complete, F.lit("released")).otherwise(F.lit("pending")))
           .withColumn("release_at", F.when(complete, F.col("_upto").cast("long")))
           .drop("_upto", "_n"))
    return out.unionByName(rejected)


def first_by(df: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """O3: the first row per key by ``order`` (a ``min_by`` aggregate, combined
    map-side; ties broken by the later order columns)."""
    s = F.struct(*order, *[c for c in keep if c not in order])
    return (df.groupBy(*key).agg(F.min(s).alias("_f"), F.count(F.lit(1)).alias("n"))
            .select(*key, *[F.col(f"_f.{c}").alias(c) for c in keep], "n"))
