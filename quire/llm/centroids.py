"""k-means over exact integers with an incremental distance matrix.

Every vector keeps its integer components and one exact dot product per
centroid. When centroids move, a dot product changes by the vector's product
with the moved components alone; squared distances and the nearest centroid
follow from it, ``|x|^2 - 2 x.c + |c|^2``. The rows with their dot products are
written after every round (two generations are kept), so a lost executor costs
one round at most. Sums per cluster are made where the rows are and added up
by Spark; centroids are the only thing the driver holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C
from quire.session import scratch_path
from quire.sinks.files import remove_folder

DIM, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
# Vectors with a component beyond this have squared distances that may not fit a long.
WIDEST = 1 << 17
_STATE = "vec_id long, x binary, dots binary, cluster int, distance long, sums array<long>"


def kept_vectors(table: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, x, wide): integer components as little-endian longs of the
    vectors with exactly ``dim`` components, none null or non-finite; wide
    vectors have a component beyond ``WIDEST`` and no x."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(v) == dim) & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(fine, v).alias("v")).where("v IS NOT NULL")

    def run(batches):
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
            wide = (np.abs(v) > WIDEST).any(axis=1)
            x = np.floor(np.where(wide[:, None], 0.0, v) * scale).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), _binary(x, wide), pa.array(wide)], ["vec_id", "x", "wide"])

    return rows.mapInArrow(run, "vec_id long, x binary, wide boolean")


def _binary(rows: np.ndarray, null=None) -> pa.Array:
    """Every row of an int64 matrix as one binary value."""
    width = rows.shape[1] * 8
    data = rows.tobytes()
    return pa.array([None if null is not None and null[i] else data[i * width:(i + 1) * width] for i in range(len(rows))], pa.binary())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), width)


def start_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """Vectors with the smallest hashes of their id; equal ids by their components."""
    hashed = rows.where("x IS NOT NULL AND vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    return [np.frombuffer(r["x"], np.int64).tolist() for r in hashed.orderBy("h", "x").limit(clusters).collect()]


def _step(rows: DataFrame, old: list, new: list, dim: int) -> DataFrame:
    """Moves every row's dot products from ``old`` to ``new`` centroids and
    assigns it anew; the last row of each task holds its sums per cluster."""
    k = len(new)
    centres = np.array(new, np.int64).reshape(k, dim)
    delta = centres - (np.array(old, np.int64).reshape(k, dim) if old else 0)
    moved = [(j, np.flatnonzero(delta[j]), delta[j][delta[j] != 0]) for j in range(k)]
    norms = (centres * centres).sum(axis=1)

    def run(batches):
        sums = np.zeros((k, dim + 2), np.int64)

        def result(ids, x, dots, cluster, distance, total):
            return pa.RecordBatch.from_arrays(
                [ids, x, dots, cluster, distance, pa.array(total, pa.list_(pa.int64()))], ["vec_id", "x", "dots", "cluster", "distance", "sums"])

        for b in batches:
            x = _matrix(b.column("x"), dim)
            dots = _matrix(b.column("dots"), k).copy() if old else np.zeros((len(x), k), np.int64)
            for j, at, by in moved:
                if len(at):
                    dots[:, j] += x[:, at] @ by
            dist = (x * x).sum(axis=1)[:, None] - 2 * dots + norms
            best = dist.argmin(axis=1)
            least = dist[np.arange(len(x)), best]
            for j in np.unique(best).tolist():
                mine = best == j
                sums[j, 0] += mine.sum()
                sums[j, 1] += least[mine].sum()
                sums[j, 2:] += x[mine].sum(axis=0)
            yield result(b.column("vec_id"), b.column("x"), _binary(dots), pa.array(best.astype(np.int32)), pa.array(least), [None] * len(x))
        yield result(pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                     pa.array([None], pa.int32()), pa.array([None], pa.int64()), [sums.ravel().tolist()])

    return rows.mapInArrow(run, _STATE)


def _totals(state: DataFrame, clusters: int, dim: int) -> list[list[int]]:
    """Per cluster: count, inertia and component sums, exact."""
    parts = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "v"))
    got = {r["at"]: int(r["s"]) for r in parts.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}
    return [[got.get(j * (dim + 2) + i, 0) for i in range(dim + 2)] for j in range(clusters)]


def clustered(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, clusters: int = CLUSTERS,
              rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256:
    one row per kept vector.

    Vectors that are null, have another length, or hold a null, NaN or
    infinite component are left out. Vectors with a component beyond
    ``WIDEST``, whose distances may not fit a long, are returned without
    cluster and take no part. Rows that repeat an id are vectors of their own;
    rows without id are assigned but never start as a centroid. Fewer kept
    vectors than clusters give as many centroids; none, or an empty table,
    gives rows without cluster only. Ties go to the smaller number. Other columns
    are not read.
    """
    spark = table.sparkSession
    C.prepare(spark)
    rows = C.stored(kept_vectors(table, id_col, vector_col, dim, scale), "centroids-rows")
    centres = start_centroids(rows, clusters, seed)
    bare = [F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"),
                                                      ("inertia", "long"), ("centroid_sha256", "string"))]
    wide = rows.where("wide" if centres else "true").select("vec_id", *bare)
    if not centres:
        return wide
    state, k, old = rows.where("NOT wide").select("vec_id", "x"), len(centres), []
    written: list[str] = []
    for step in range(rounds + 1):
        path = scratch_path(spark, "centroids-state")
        _step(state, old, centres, dim).write.parquet(path)
        written.append(path)
        everything = spark.read.schema(_STATE).parquet(path)
        totals = _totals(everything, k, dim)
        state = everything.where("sums IS NULL")
        if len(written) > 2:
            remove_folder(spark, written.pop(0))
        if step < rounds:
            old, centres = centres, [[s // t[0] for s in t[2:]] if t[0] else c for t, c in zip(totals, centres, strict=True)]
    about = spark.createDataFrame([(j, t[1], sum(x[1] for x in totals), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
                                   for j, (t, c) in enumerate(zip(totals, centres, strict=True))],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = state.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out.unionByName(wide)
