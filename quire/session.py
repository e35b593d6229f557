"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every quire job assumes. Timestamps are compared across engines,
# so the session time zone is pinned to UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "quire", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with quire's base settings.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a
    cluster the launcher supplies them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", "8g")
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers (the ``--py-files`` way):
    zip the package once per session and add it with ``addPyFile``."""
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="quire-pyfiles-"), "quire.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(id(sc))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the launcher (a shared file
    system); we never invent a machine-local one there. In local mode
    (tests) a scratch folder is created when the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        d = str(d)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="quire-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for written tables
    (in that folder's own file system; writers create it)."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# Rows and bytes of one Arrow batch, so that long texts do not pile up in a worker.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Settings of the operators that hand texts to Python; safe to call again."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Rows dealt by ``cols`` to as many tasks as a shuffle has: for work that
    costs far more than the bytes it reads tell, which Spark would put into a
    few tasks. Without a number AQE would merge them again."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


# What a broadcast may weigh, measured before it is sent.
MAX_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows
    that weigh at most ``MAX_BROADCAST_BYTES``.

    Returns ``(frame, broadcasted)``. The check reads at most
    ``max_rows + 1`` rows and sums their widths (the bytes of strings, eight
    for anything else); above a bound the frame is returned as-is and the
    planner picks a shuffle join (AQE can still demote it at runtime).
    """
    from pyspark.sql import functions as F

    width = F.lit(16)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("long"))).head()
    if n <= max_rows and (size or 0) <= MAX_BROADCAST_BYTES:
        return F.broadcast(df), True
    return df, False


def keyed_filter(big: DataFrame, keys: DataFrame, on: list[str] | str, how: str,
                 max_rows: int) -> DataFrame:
    """Semi/anti join of a large stored table with a batch's key set.

    When the key set is proven to hold at most ``max_rows`` rows it is
    broadcast, so the large side is only scanned - never shuffled. Above the
    bound a Bloom filter of the keys is broadcast instead: stored rows that
    are certainly not among them never reach the exact join's exchange.
    """
    k, small = bounded_broadcast(keys, max_rows)
    if small:
        return big.join(k, on, how)
    from quire.operators import bloom

    cols = [on] if isinstance(on, str) else on
    rows = bloom.marked(big, keys, cols)
    near = rows.where("_maybe").drop("_maybe").join(k, on, how)
    if how == "left_semi":
        return near
    if how == "left_anti":
        return near.unionByName(rows.where("NOT _maybe").drop("_maybe"))
    raise ValueError(f"unsupported join {how!r}")
