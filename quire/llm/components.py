"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges ``(a, b)``, a > b. Large stars tie every larger
    neighbour of a node to the node's smallest neighbour, small stars the node
    and its smaller neighbours. Minima are pre-aggregated before the shuffle;
    the join back is an inner join, so that a hot centre can be split."""
    if large:
        sym = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = sym.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low)
    return out.where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, component): every node that has a link, with
    the smallest node it reaches. The loop ends when the edges no longer
    change; all edges then point at their component's smallest node."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "cc-edges")
    mark = F.struct(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"))
    before = edges.agg(mark).head()[0]
    while True:
        edges = stored(_stars(_stars(edges, True), False), "cc-edges")
        now = edges.agg(mark).head()[0]
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())
