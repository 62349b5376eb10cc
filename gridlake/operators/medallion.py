"""Bronze -> silver -> gold -> serving.

``as_of`` replaces every ``current_timestamp()``: one literal per run, so the
window start, the ``updated_at`` stamp and the serving filter agree, and a rerun
gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions import time as T
from gridlake.functions.money import avg_exact_price, exact, money, to_cents
from gridlake.operators.revisions import latest_revision
from gridlake.schemas import KEYS, LOCAL_TZ

SILVER_COLUMNS = [
    "region",
    "delivery_ts",
    "price_eur_mwh",
    "local_ts",
    "local_hour",
    "is_weekend",
    "is_negative",
    "source",
    "updated_at",
]


def enrich(deduped: DataFrame, as_of: Column, tz: str = LOCAL_TZ) -> DataFrame:
    """Local wall clock, local hour, weekend and negative flags, update stamp.

    ``is_negative`` is taken on the unrounded price (strictly below zero).
    """
    local = T.local_ts("delivery_ts", tz)
    return deduped.select(
        "region",
        "delivery_ts",
        "price_eur_mwh",
        local.alias("local_ts"),
        F.hour(local).alias("local_hour"),
        T.is_weekend(local).alias("is_weekend"),
        (F.col("price_eur_mwh") < 0).alias("is_negative"),
        "source",
        as_of.alias("updated_at"),
    )


def in_window(df: DataFrame, as_of: Column, since_hours: int | None, align_days: bool = True) -> DataFrame:
    """Rows with ``delivery_ts >= window start``; the window is open towards
    the future. ``since_hours=None`` keeps everything."""
    if since_hours is None:
        return df
    return df.where(F.col("delivery_ts") >= T.window_start(as_of, since_hours, align_days))


def silver(
    bronze: DataFrame,
    as_of: Column,
    since_hours: int | None = None,
    align_days: bool = True,
) -> DataFrame:
    """Silver rows recomputed from bronze: window filter first (it reaches the
    scan), then the newest revision per key, then enrichment."""
    windowed = in_window(bronze, as_of, since_hours, align_days)
    return enrich(latest_revision(windowed, KEYS), as_of)


def gold_daily(silver_rows: DataFrame, as_of: Column) -> DataFrame:
    """Per (region, local day): average, min and max of the raw prices, each rounded
    once to cents, and the number of negative hours. Aggregates run on exact decimals
    (partial + final hash aggregation)."""
    c = exact("price_eur_mwh")
    return (
        silver_rows.groupBy("region", F.to_date("local_ts").alias("local_day"))
        .agg(
            F.sum(c).alias("total"),
            F.count(c).alias("n"),
            F.min(c).alias("low"),
            F.max(c).alias("high"),
            F.count_if(F.col("is_negative")).cast("int").alias("negative_hours"),
        )
        .select(
            "region",
            "local_day",
            avg_exact_price(F.col("total"), F.col("n")).alias("avg_price"),
            to_cents(F.col("low")).alias("min_price"),
            to_cents(F.col("high")).alias("max_price"),
            "negative_hours",
            as_of.alias("updated_at"),
        )
    )


def serving_hourly(silver_rows: DataFrame) -> DataFrame:
    """Serving projection: price as ``numeric(10,2)``, NULLs as 0 / false;
    ``source`` and ``local_ts`` are not carried."""
    return silver_rows.select(
        "region",
        "delivery_ts",
        money(F.coalesce(F.col("price_eur_mwh"), F.lit(0.0))).alias("price_eur_mwh"),
        "local_hour",
        F.coalesce(F.col("is_weekend"), F.lit(False)).alias("is_weekend"),
        F.coalesce(F.col("is_negative"), F.lit(False)).alias("is_negative"),
        "updated_at",
    )


def serving_daily(gold_rows: DataFrame, refreshed_since: Column | None = None) -> DataFrame:
    """Serving projection of gold rows refreshed since the window start."""
    if refreshed_since is not None:
        gold_rows = gold_rows.where(F.col("updated_at") >= refreshed_since)
    zero = F.lit(0.0)
    return gold_rows.select(
        "region",
        "local_day",
        money(F.coalesce(F.col("avg_price"), zero)).alias("avg_price"),
        money(F.coalesce(F.col("min_price"), zero)).alias("min_price"),
        money(F.coalesce(F.col("max_price"), zero)).alias("max_price"),
        F.coalesce(F.col("negative_hours"), F.lit(0)).alias("negative_hours"),
        "updated_at",
    )
