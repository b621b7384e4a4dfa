"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins (size-checked
# broadcast, skew splitting) and coalesces shuffle partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Long generated plans (wide feature sets) stay readable in logs.
    "spark.sql.maxPlanStringLength": "200000",
}

# Local-mode only: the driver JVM is the executor.
LOCAL_CONF = {
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidewatch") -> SparkSession:
    """Return the active session or build one with the defaults above.

    On a cluster the session normally exists already (spark-submit); then
    only the SQL settings that are safe to change at run time are applied.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_CONF.items():
                builder = builder.config(k, v)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared (HDFS/object-store) folder there; we only
    fall back to a local folder when nothing is configured (tests, laptops).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join("/tmp", "tidewatch-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewatch/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, for
    sessions that were started without it on their workers' path."""
    package = Path(__file__).resolve().parent
    application = spark.sparkContext.applicationId
    if application in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidewatch-code-")) / "tidewatch_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


_MATERIALIZED: dict[tuple, object] = {}


def cached(spark, key: tuple, build):
    """Return the materialized frame stored under ``key`` for this
    application, building (and checkpointing) it on first use only."""
    full = (spark.sparkContext.applicationId,) + tuple(key)
    hit = _MATERIALIZED.get(full)
    if hit is None:
        hit = materialize(build())
        _MATERIALIZED[full] = hit
    return hit


def materialize(df, key: tuple | None = None):
    """Cut lineage by writing a Parquet table into the shared folder named by
    ``spark.checkpoint.dir`` and reading it back.

    Used for small derived frames (panels: symbols x days, per-feature
    statistics) that several downstream jobs read, so the large scan/join
    behind them runs once and a lost executor never forces a recomputation
    from the raw tables.  Unlike ``checkpoint()`` without caching, the plan
    runs once; the read-back carries file sizes, so AQE can size-check a
    broadcast of it.  With a ``key`` the result is reused in the application.
    """
    spark = df.sparkSession
    if key is not None:
        full = (spark.sparkContext.applicationId,) + tuple(key)
        hit = _MATERIALIZED.get(full)
        if hit is not None:
            return hit
    path = scratch_path(spark, "mat")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    if key is not None:
        _MATERIALIZED[full] = out
    return out


# Largest frame (rows) shipped to every executor by a forced broadcast.
BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(df, max_rows: int = BROADCAST_MAX_ROWS):
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else
    ``df`` unchanged (Spark then shuffles both sides on the key).

    Meant for small derived frames (one row per symbol, per feature) that
    are already materialized; the check is one count that stops reading
    after ``max_rows + 1`` rows.
    """
    from pyspark.sql import functions as F
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
