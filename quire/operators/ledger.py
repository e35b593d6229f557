"""Per-URL change ledger (U1, W1, T3, A1, J1, J2, K1 state, R1).

The ledger holds one row per URL: ``(source_id, url, modified_at)``. A batch
of items is decided in arrival order (``seq``) against it:

=========  ====================  =====================
state      item with time t      item without time
=========  ====================  =====================
absent     accept, state = t     accept, state = null
null       drop                  drop
m          accept iff t <> m     drop
=========  ====================  =====================

(policy ``"newer"`` accepts iff ``t > m`` instead of ``t <> m``.)

Set-wise form: union the touched ledger rows (``seq = -1``) with the batch;
per URL in ``seq`` order a row is accepted iff it is an item and either it is
the URL's first row, or it has a time, the URL's first row has a time, and
its time differs from the last non-null time before it.

Skew: a per-URL window would put a hot URL's whole history in one task. The
scan is therefore split by ``seq`` range into chunks: a window per
``(url, chunk)`` computes everything local, one small per-chunk summary row
heads the chunk and carries the "last time before this chunk" across chunks. Windows and
summaries only see ``(url, seq, modified_at)``; the wide rows are shuffled
once, to be marked with the accepted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.dates import if_modified_since

LEDGER_COLUMNS = ["source_id", "url", "modified_at"]
# Rows of one URL per chunk of arrival order; bounds a hot URL's task size.
DEFAULT_CHUNK = 1 << 20
# One mark per source; above this the marks are joined by shuffle.
MAX_BROADCAST_MARKS = 100_000
# URLs of one batch broadcast against the stored ledger (so the ledger is
# scanned, not shuffled); larger batches use a shuffle join.
MAX_BROADCAST_BATCH_URLS = 100_000


def _prev_expr(policy: str, m: Column, w) -> Column:
    if policy == "different":
        return F.last(m, ignorenulls=True).over(w)
    if policy == "newer":
        return F.max(m).over(w)
    raise ValueError(f"unknown policy {policy!r}")


def decide(items: DataFrame, ledger: DataFrame | None = None, *,
           url_col: str = "source_url", policy: str = "different",
           chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Mark each item ``accepted`` against the ledger, in ``seq`` order.

    ``items`` needs ``seq`` (unique per URL), ``source_id``, ``url_col`` and
    ``modified_at``; every other column is carried through. Returns all
    items with a boolean ``accepted`` column; a null URL or ``seq`` has no
    place in the order and is not accepted.
    """
    m = F.col("modified_at")
    keys = items.select(F.col(url_col).alias("_url"), "seq", m, F.lit(False).alias("_ledger"))
    feed = keys.where("_url IS NOT NULL AND seq IS NOT NULL")
    if ledger is not None:
        from quire.session import keyed_filter

        touched = feed.select(F.col("_url").alias("url")).distinct()
        prior = (keyed_filter(ledger, touched, "url", "left_semi", MAX_BROADCAST_BATCH_URLS)
                 .select(F.col("url").alias("_url"), F.lit(-1).cast("long").alias("seq"), m, F.lit(True).alias("_ledger")))
        feed = feed.unionByName(prior)
    feed = feed.withColumn("_chunk", F.expr(f"seq div {int(chunk)}"))

    if policy == "different":
        chunk_last = F.max_by(m, F.when(m.isNotNull(), F.col("seq")))
    else:
        chunk_last = F.max(m)
    summary = (feed.groupBy("_url", "_chunk")
               .agg(F.min_by(m, F.col("seq")).alias("_chunk_first_m"),
                    chunk_last.alias("_chunk_last")))
    w_url = Window.partitionBy("_url")
    w_carry = Window.partitionBy("_url").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        "_url", F.lit(None).cast("long").alias("seq"),
        _prev_expr(policy, F.col("_chunk_last"), w_carry).alias("modified_at"), F.lit(False).alias("_ledger"), "_chunk",
        F.struct(
            F.min_by(F.struct(F.col("_chunk_first_m").alias("m")), F.col("_chunk")).over(w_url)["m"].alias("fm"),
            (F.col("_chunk") == F.min("_chunk").over(w_url)).alias("first_chunk")).alias("_head"))

    # the summary is the row that heads its chunk (no ``seq``: it sorts first) and
    # brings the time before it: nothing is joined, so nothing can be broadcast
    w_local = Window.partitionBy("_url", "_chunk").orderBy(F.col("seq").asc_nulls_first())
    w_before = w_local.rowsBetween(Window.unboundedPreceding, -1)
    j = (feed.withColumn("_head", F.lit(None).cast(summary.schema["_head"].dataType)).unionByName(summary)
         .withColumn("_rn", F.row_number().over(w_local))
         .withColumn("_prev", _prev_expr(policy, m, w_before))
         .withColumn("_head", F.first("_head").over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .where("seq IS NOT NULL"))
    changed = F.col("_prev") != m if policy == "different" else m > F.col("_prev")
    first_row = F.col("_head.first_chunk") & (F.col("_rn") == 2)
    accepted = first_row | (m.isNotNull() & F.col("_head.fm").isNotNull() & F.coalesce(changed, F.lit(False)))
    good = (j.where(~F.col("_ledger") & accepted)
            .select("_url", F.col("seq").alias("_seq"), F.lit(True).alias("_accepted")).distinct())
    # a left join: no item can get lost, whatever its key; both sides grow with
    # the batch and are joined where they lie, not by way of the driver
    return (items.join(good.hint("merge"), (items[url_col] == good["_url"]) & (items["seq"] == good["_seq"]), "left")
            .select(*[items[c] for c in items.columns], F.coalesce("_accepted", F.lit(False)).alias("accepted")))


def accept(items: DataFrame, ledger: DataFrame | None = None, **kw) -> DataFrame:
    """Only the accepted items (P3 drops the rest)."""
    return decide(items, ledger, **kw).where("accepted").drop("accepted")


def apply(ledger: DataFrame | None, decided: DataFrame, *, url_col: str = "source_url") -> DataFrame:
    """New ledger state: untouched rows plus the last accepted item per URL.

    The per-URL reduction is a ``max_by`` aggregate (map-side partial
    aggregation), so a hot URL is combined before the shuffle.
    """
    acc = decided.where("accepted")
    last = (acc.groupBy(F.col(url_col).alias("url"))
            .agg(F.max_by(F.struct("source_id", "modified_at"), "seq").alias("s"))
            .select(F.col("s.source_id").alias("source_id"), "url",
                    F.col("s.modified_at").alias("modified_at")))
    if ledger is None:
        return last
    from quire.session import keyed_filter

    kept = keyed_filter(ledger, last.select("url"), "url", "left_anti",
                        MAX_BROADCAST_BATCH_URLS).select(*LEDGER_COLUMNS)
    return kept.unionByName(last)


def high_water_mark(ledger: DataFrame) -> DataFrame:
    """A1: latest stored time per source (null when it has only null times)."""
    return (ledger.groupBy("source_id")
            .agg(F.max("modified_at").alias("high_water_mark"))
            .withColumn("start_date", F.date_format("high_water_mark", "yyyy-MM-dd")))


def since_mark(feed: DataFrame, marks: DataFrame, time_col: str = "modified_at") -> DataFrame:
    """Keep feed rows at or after their source's mark cut to the day.

    Sources without a mark (or with a null mark) are read whole.
    """
    from quire.session import bounded_broadcast

    m, _ = bounded_broadcast(marks.select("source_id", "start_date"), MAX_BROADCAST_MARKS)
    j = feed.join(m, "source_id", "left")
    keep = F.col("start_date").isNull() | (F.col(time_col) >= F.to_timestamp("start_date"))
    return j.where(keep).drop("start_date")


def refresh_plan(frontier: DataFrame, ledger: DataFrame) -> DataFrame:
    """Fetch decision per request.

    ``force_refresh`` -> fetch; known with a time and ``dont_refresh`` ->
    skip; known with a time -> conditional fetch with If-Modified-Since;
    unknown, or known without a time -> fetch.
    """
    j = frontier.join(ledger.select("url", F.col("modified_at").alias("stored_at")), "url", "left")
    force = F.coalesce(F.col("force_refresh"), F.lit(False))
    dont = F.coalesce(F.col("dont_refresh"), F.lit(False))
    known = ~force & F.col("stored_at").isNotNull()
    action = (F.when(known & dont, F.lit("skip"))
              .when(known, F.lit("conditional"))
              .otherwise(F.lit("fetch")))
    return (j.withColumn("action", action)
            .withColumn("if_modified_since",
                        F.when(action == "conditional", if_modified_since("stored_at"))))


def skip_known(frontier: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests whose URL is not already held with a time."""
    held = ledger.where(F.col("modified_at").isNotNull()).select("url")
    return frontier.join(held, "url", "left_anti")


def versions(decided: DataFrame, *, url_col: str = "source_url", chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Version number per URL over accepted items, in arrival order
    (a chunked running count, so a hot URL is scanned in parallel)."""
    from quire.operators.ordering import running

    acc = decided.where("accepted").drop("accepted")
    return running(acc, [url_col], "seq", {"version": ("count", "seq")}, chunk)


def as_of(decided: DataFrame, seq, *, url_col: str = "source_url") -> DataFrame:
    """The corpus as it stood after arrival ``seq``: per URL the columns
    of its last accepted item up to then (an aggregate combined map-side)."""
    rest = [c for c in decided.columns if c not in (url_col, "accepted")]
    return (decided.where(F.col("accepted") & (F.col("seq") <= seq))
            .groupBy(url_col).agg(F.max_by(F.struct(*rest), "seq").alias("_i")).select(url_col, "_i.*"))
