"""Spark session settings the library relies on.

Every time rule in the library assumes the session time zone is UTC: instants
are stored as ``timestamp`` and ``hour()``/``dayofweek()`` on a local wall-clock
column are only right when no second conversion happens. ``ensure_utc`` pins
it on a session someone else built (the driver's, a notebook's).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings applied to sessions we build. Shuffle partitions stay a parameter:
# on a cluster they are sized from the input (about 128-256 MB per task after
# AQE coalescing), locally they match the cores.
DEFAULTS = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size post-shuffle partitions by bytes (advisoryPartitionSizeInBytes), not
    # by keeping the default parallelism: fewer tiny tasks on a busy cluster.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "gridlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only applied when given; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("GRIDLAKE_DRIVER_MEMORY", "8g"))
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("GRIDLAKE_LOG_LEVEL", "WARN"))
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (runtime setting, cheap, idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def bound_arrow_batches(spark: SparkSession, rows: int) -> None:
    """At most ``rows`` rows cross to Python at a time, for rows that are whole documents: the
    setting holds for the session from now on (it is read when a plan runs); a smaller one stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, as configured on the session."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured ``spark.checkpoint.dir``; only when none is set (local
    tests) fall back to a fresh scratch folder. A cluster must configure a shared
    folder, so this never picks a machine-local one there."""
    existing = checkpoint_dir(spark)
    if existing:
        spark.sparkContext.setCheckpointDir(existing)
        return existing
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="gridlake-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
