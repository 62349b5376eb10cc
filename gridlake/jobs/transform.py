"""Hourly batch: bronze -> silver -> gold -> serving, over a trailing window.

Recomputing a window (instead of tracking a high-water mark) picks up late
revisions inside the window and keeps the job idempotent. Every step reads
only the partitions it needs: the window start becomes a literal partition
filter (``delivery_date >= ...``) that prunes the bronze and silver scans.
Silver is read once for gold and serving (persisted for the run); no row
goes through the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import lake as L
from gridlake.functions.time import ts_literal, window_start
from gridlake.operators import medallion as M
from gridlake.schemas import BRONZE, CHANGES, GOLD_DAILY, SERVING_DAILY, SERVING_HOURLY, SILVER
from gridlake.sinks import tables as TB

WINDOW_HOURS = 168


def _window_filter(as_of, since_hours: int | None, align_days: bool):
    if since_hours is None:
        return F.lit(True)
    start = window_start(as_of, since_hours, align_days)
    # The partition predicate is implied by the row predicate; stating it
    # lets Parquet partition pruning skip whole days.
    return (F.col("delivery_date") >= F.to_date(start) - F.expr("INTERVAL 1 DAY")) & (F.col("delivery_ts") >= start)


def run_transform(
    spark: SparkSession,
    lake: L.Lake,
    as_of: str | dt.datetime,
    since_hours: int | None = WINDOW_HOURS,
    align_days: bool = True,
    run_id: str | None = None,
) -> dict[str, int]:
    """Recompute the trailing ``since_hours`` (``None``: the whole history)."""
    run_id = run_id or f"transform-{str(as_of).replace(' ', 'T').replace(':', '')}"
    now = ts_literal(as_of)
    bronze = TB.read_table(spark, lake.path(L.BRONZE), L.stored(BRONZE, L.BRONZE)).where(_window_filter(now, since_hours, align_days))
    incoming = L.with_delivery_date(M.silver(bronze.drop("delivery_date"), now))
    TB.merge_into(
        spark, lake.path(L.SILVER), SILVER, incoming, L.SILVER.keys, L.SILVER.partition_cols,
        f"{run_id}-silver", version=None,
    )

    silver = TB.read_table(spark, lake.path(L.SILVER), L.stored(SILVER, L.SILVER)).where(_window_filter(now, since_hours, align_days))
    silver = silver.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gold = M.gold_daily(silver, now)
        TB.merge_into(
            spark, lake.path(L.GOLD_DAILY), GOLD_DAILY, gold, L.GOLD_DAILY.keys, L.GOLD_DAILY.partition_cols,
            f"{run_id}-gold", version=None,
        )
        hourly = L.with_delivery_date(M.serving_hourly(silver))
        TB.merge_into(
            spark, lake.path(L.SERVING_HOURLY), SERVING_HOURLY, hourly, L.SERVING_HOURLY.keys,
            L.SERVING_HOURLY.partition_cols, f"{run_id}-serving-hourly", version=None,
        )
        refreshed = TB.read_table(spark, lake.path(L.GOLD_DAILY), GOLD_DAILY)
        start = None
        if since_hours is not None:
            start = window_start(now, since_hours, align_days)
            # Gold rows stamped since ``start`` were written by runs whose own
            # window reached back at most ``since_hours`` before ``start``:
            # that bounds the partitions to read.
            earliest = window_start(start, since_hours, align_days)
            refreshed = refreshed.where(F.col("local_day") >= F.to_date(earliest) - 1)
        daily = M.serving_daily(refreshed, refreshed_since=start)
        TB.merge_into(
            spark, lake.path(L.SERVING_DAILY), SERVING_DAILY, daily, L.SERVING_DAILY.keys,
            L.SERVING_DAILY.partition_cols, f"{run_id}-serving-daily", version=None,
        )
        hours = silver.count()
    finally:
        silver.unpersist()
    return {"hourly_rows": hours}


def changes(spark: SparkSession, lake: L.Lake) -> DataFrame:
    """Entries of the change log that no run has recomputed yet: entry_id, delivery_date, newest,
    logged_day."""
    logged = TB.read_table(spark, lake.path(L.BRONZE_CHANGES), CHANGES)
    done = TB.read_table(spark, lake.path(L.RECOMPUTED), CHANGES)
    return logged.join(done, ["entry_id", "delivery_date"], "left_anti").select(*CHANGES.fieldNames())


def run_changed_days(spark: SparkSession, lake: L.Lake, as_of: str | dt.datetime, run_id: str | None = None) -> dict[str, int]:
    """Recompute silver, gold and serving of the days that bronze merges have touched since the
    last such run. The days (not their rows) are read on the driver and become literal partition
    filters. A crash before the end leaves the entries open, and the next run repeats them."""
    run_id = run_id or f"changed-{str(as_of).replace(' ', 'T').replace(':', '')}-{uuid.uuid4().hex[:8]}"
    now = ts_literal(as_of)
    entries = changes(spark, lake).collect()  # a row per merge and day since the last run
    days = sorted({r.delivery_date for r in entries})
    if not days:
        return {"days": 0}
    # A UTC day has hours of two local days, and a local day those of two UTC days.
    day = dt.timedelta(days=1)
    local_days = sorted({d + k * day for d in days for k in (0, 1)})
    around = sorted({d + k * day for d in local_days for k in (-1, 0)})

    def merge(table, schema, rows, step):
        TB.merge_into(spark, lake.path(table), schema, rows, table.keys, table.partition_cols, f"{run_id}-{step}", version=None)

    bronze = TB.read_table(spark, lake.path(L.BRONZE), L.stored(BRONZE, L.BRONZE)).where(F.col("delivery_date").isin(days))
    merge(L.SILVER, SILVER, L.with_delivery_date(M.silver(bronze.drop("delivery_date"), now)), "silver")
    silver = TB.read_table(spark, lake.path(L.SILVER), L.stored(SILVER, L.SILVER)).where(F.col("delivery_date").isin(around))
    silver = silver.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gold = M.gold_daily(silver.where(F.to_date("local_ts").isin(local_days)), now)
        merge(L.GOLD_DAILY, GOLD_DAILY, gold, "gold")
        hourly = L.with_delivery_date(M.serving_hourly(silver.where(F.col("delivery_date").isin(days))))
        merge(L.SERVING_HOURLY, SERVING_HOURLY, hourly, "serving-hourly")
    finally:
        silver.unpersist()
    refreshed = TB.read_table(spark, lake.path(L.GOLD_DAILY), GOLD_DAILY).where(F.col("local_day").isin(local_days))
    merge(L.SERVING_DAILY, SERVING_DAILY, M.serving_daily(refreshed), "serving-daily")
    done = spark.createDataFrame([tuple(r) for r in entries], CHANGES)
    done.coalesce(1).write.mode("append").partitionBy("logged_day").parquet(lake.path(L.RECOMPUTED))
    return {"days": len(days)}
