"""Request frontier: dedup, retry triage, cacheable responses, link-chain and
tree expansion (U8, T5, S11, P16, N4, N5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import retry_seconds
from quire.session import cut_lineage

# Status codes.
RETRY_STATUSES = [429, 503]
NOT_MODIFIED = 304
# Responses not kept in the raw store.
UNCACHEABLE_STATUSES = [401, 403, 429, 500, 502, 503]


def dedup_requests(requests: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """U8: one request per URL - the earliest by ``order``.

    ``min_by`` aggregate: combined map-side, so a hot URL never travels whole.
    """
    others = [c for c in requests.columns if c not in (key, order)]
    return (requests.groupBy(key)
            .agg(F.min_by(F.struct(order, *others), F.col(order)).alias("_r"))
            .select(key, "_r.*"))


def triage(responses: DataFrame) -> DataFrame:
    """429/503 -> retry after Retry-After seconds (else 30);
    304 -> drop; anything else -> accept."""
    retry = F.col("status").isin(RETRY_STATUSES)
    delay = F.when(retry, retry_seconds(F.col("retry_after").try_cast("int")))
    return (responses
            .withColumn("action", F.when(retry, F.lit("retry"))
                        .when(F.col("status") == NOT_MODIFIED, F.lit("drop"))
                        .otherwise(F.lit("accept")))
            .withColumn("delay_s", delay)
            .withColumn("next_attempt_at", F.when(retry, F.timestamp_add("SECOND", delay, F.col("received_at")))))


def cacheable(responses: DataFrame) -> DataFrame:
    """Responses stored in the raw response table."""
    return responses.where(~F.col("status").isin(UNCACHEABLE_STATUSES))


def chain(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """N4 for next-page links (no node has two): ``(node, depth)`` of every
    node that ``seeds(node)`` reach, in O(log n) steps.

    Links are doubled: after step k an edge leads 2^k pages ahead and the
    nodes closer than 2^k are known, so a chain of a million pages takes 20
    steps. On a cycle no new node appears and the walk ends; the smallest
    depth counts where chains meet."""
    jump = cut_lineage(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    known = cut_lineage(seeds.where("node IS NOT NULL").select("node", F.lit(0).alias("depth")).distinct())
    count, step = known.count(), 1
    while True:
        ahead = known.join(jump.hint("merge"), known["node"] == jump["src"]).select(F.col("dst").alias("node"), (F.col("depth") + step).alias("depth"))
        known = cut_lineage(known.unionByName(ahead).groupBy("node").agg(F.min("depth").alias("depth")))
        now = known.count()
        if now == count:
            return known
        count, step = now, step * 2
        far = jump.select(F.col("src").alias("mid"), F.col("dst").alias("to"))
        jump = cut_lineage(jump.join(far.hint("merge"), F.col("dst") == F.col("mid")).select("src", F.col("to").alias("dst")))


# Frontier pieces kept apart before they are folded into one.
FOLD_PIECES = 8
# A frontier of at most this many nodes is broadcast to the edges.
MAX_BROADCAST_FRONTIER = 100_000


def walk(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Expand ``seeds(node)`` along ``edges(src, dst)`` until no new
    node appears. Returns ``(node, depth)`` with the first depth reached;
    nodes already seen are never expanded again, so the walk ends by itself
    however long a chain is. Null nodes are not followed.

    Each step is one join and one anti join; only the frontier's size and a
    frontier counted to be small reach the driver. Edges and seen nodes are
    never broadcast: every step would send them all again. Edges are
    partitioned by ``src`` once; every new frontier is cut into the shared
    checkpoint folder, and after ``FOLD_PIECES`` steps the seen pieces become
    one, so that neither a plan nor the number of files a step reads grows with
    the length of the walk. Where no node has two next ones (chains of pages),
    :func:`chain` takes logarithmically many steps.
    """
    links = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    if links.groupBy("src").count().where("count > 1").isEmpty():
        return chain(seeds, links)
    edges = cut_lineage(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct().repartition("src"))
    frontier = cut_lineage(seeds.select(F.col("node"), F.lit(0).alias("depth")).distinct())
    pieces, depth, count = [frontier], 0, frontier.count()

    def seen():
        out = pieces[0]
        for p in pieces[1:]:
            out = out.unionByName(p)
        return out

    while True:
        depth += 1
        now = frontier.hint("broadcast" if count <= MAX_BROADCAST_FRONTIER else "merge")
        frontier = cut_lineage(
            edges.join(now, edges.src == now.node)
            .select(F.col("dst").alias("node")).distinct()
            .join(seen().select("node").hint("merge"), "node", "left_anti")
            .withColumn("depth", F.lit(depth)))
        count = frontier.count()
        if not count:
            return seen()
        pieces.append(frontier)
        if len(pieces) > FOLD_PIECES:
            pieces = [cut_lineage(seen())]
