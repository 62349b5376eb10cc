"""Table upkeep and the freshness check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from gridlake import lake as L
from gridlake.functions.time import ts_literal
from gridlake.operators import health
from gridlake.schemas import PIPELINE_HEALTH, SERVING_HOURLY
from gridlake.sinks import tables as TB

TABLES = (L.BRONZE, L.SILVER, L.GOLD_DAILY, L.NEWS, L.SERVING_HOURLY, L.SERVING_DAILY)


def maintain(
    spark: SparkSession,
    lake: L.Lake,
    run_id: str,
    min_input_files: int = 5,
    tables=TABLES,
    older_than: dt.datetime | None = None,
    retain_last: int = 10,
) -> dict[str, dict[str, int]]:
    """Compact small files of every table that has data, then expire staged
    copies older than ``older_than`` (timezone-aware; keeps ``retain_last``)."""
    if older_than is not None and older_than.tzinfo is None:
        raise ValueError("older_than must be timezone-aware")
    out = {}
    for table in tables:
        path = lake.path(table)
        if TB.has_data(spark, path):
            out[table.name] = TB.compact(spark, path, table.partition_cols, f"{run_id}-compact", min_input_files)
            if older_than is not None:
                out[table.name]["expired_copies"] = TB.expire_staged(spark, path, older_than, retain_last)
    return out


def check_freshness(spark: SparkSession, lake: L.Lake, now: str | dt.datetime) -> dict[str, str]:
    """Write the freshness row into ``pipeline_health`` (upsert on
    check_name) and return it."""
    path = lake.path(L.SERVING_HOURLY)
    if TB.has_data(spark, path):
        serving = TB.read_table(spark, path, L.stored(SERVING_HOURLY, L.SERVING_HOURLY))
    else:
        serving = spark.createDataFrame([], "delivery_ts timestamp")
    row = health.freshness(serving, ts_literal(now))
    health_path = lake.path(L.PIPELINE_HEALTH)
    stored = TB.read_table(spark, health_path, PIPELINE_HEALTH)
    merged = stored.join(row.select("check_name"), on="check_name", how="left_anti").unionByName(row)
    TB.write_partitions(spark, merged.coalesce(1), health_path, f"health-{str(now).replace(' ', 'T').replace(':', '')}", ())
    first = row.first()
    return {"status": first["status"], "detail": first["detail"]}
