"""Freshness check of the serving layer.

Fresh means the newest delivery hour reaches the last hour that is due: 23:00
local of today from 05:00 local on, of yesterday before. Only the newest hour
is compared (a gap earlier in the day passes), as in the reference. The check is
one global ``max`` (partial + final aggregation), then a one-row projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.time import due_through, local_text

CHECK_NAME = "serving_freshness"
# --- Fixed values: status words and detail texts ------------------------------
OK, FAIL = "ok", "fail"
EMPTY_DETAIL = "serving.price_hourly is empty"
MISSING_SUFFIX = "are due and missing (the 03:00 backfill or the hourly transform did not publish them)"
# -----------------------------------------------------------------------------


def describe(latest: Column, now: Column) -> tuple[Column, Column]:
    """(status, detail) for the newest hour ``latest`` at time ``now``."""
    due = due_through(now)
    hours = (F.unix_micros(latest) - F.unix_micros(now)) / 3.6e9
    position = F.when(hours >= 0, F.format_string("%.1f h ahead", hours)).otherwise(
        F.format_string("%.1f h old", -hours)
    )
    head = F.concat(F.lit("newest hour "), local_text(latest), F.lit(" ("), position, F.lit(")"))
    fresh = latest >= due
    status = F.when(latest.isNull(), F.lit(FAIL)).when(fresh, F.lit(OK)).otherwise(F.lit(FAIL))
    detail = (
        F.when(latest.isNull(), F.lit(EMPTY_DETAIL))
        .when(fresh, F.concat(head, F.lit("; due through "), local_text(due)))
        .otherwise(F.concat(head, F.lit("; hours through "), local_text(due), F.lit(" " + MISSING_SUFFIX)))
    )
    return status, detail


def freshness(serving: DataFrame, now: Column) -> DataFrame:
    """One ``pipeline_health`` row for the serving table."""
    latest = serving.agg(F.max("delivery_ts").alias("latest"))
    status, detail = describe(F.col("latest"), now)
    return latest.select(
        F.lit(CHECK_NAME).alias("check_name"),
        status.alias("status"),
        detail.alias("detail"),
        now.alias("checked_at"),
    )


def gaps(serving: DataFrame, now: Column) -> DataFrame:
    """Runs of missing hours per region, from its first stored hour through the last one that is
    due: region, first_missing, last_missing, hours. A region has one row an hour of the calendar,
    so its hours pass through one task in order."""
    hour = F.expr("INTERVAL 1 HOUR")
    due = due_through(now)
    in_region = Window.partitionBy("region").orderBy("delivery_ts")
    following = F.coalesce(F.lead("delivery_ts").over(in_region), F.greatest(due + hour, F.col("delivery_ts") + hour))
    stored = serving.select("region", "delivery_ts").where(F.col("delivery_ts") <= due)
    steps = stored.withColumn("following", following).where(F.col("following") > F.col("delivery_ts") + hour)
    hours = (F.unix_seconds("following") - F.unix_seconds("delivery_ts")) / 3600 - 1
    return steps.select(
        "region", (F.col("delivery_ts") + hour).alias("first_missing"), (F.col("following") - hour).alias("last_missing"), hours.cast("long").alias("hours")
    )
