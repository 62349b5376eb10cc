"""Market pulse: trailing-window statistics per region.

"Published" means ``delivery_ts <= as_of``. Windows count back from the newest
published hour of the region and exclude their start (``ts > latest - n days``).
The newest hour per region is a grouped aggregate joined back on the region
(AQE broadcasts it at run time when it is small: one row per region), and each
row is exploded once into the windows it falls in, so all windows come from
one scan and one partial + final aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.money import avg_exact_price, exact, pct1, to_cents
from gridlake.functions.time import local_ts
from gridlake.schemas import PULSE_WINDOWS

LOCAL_PATTERN = "EEE dd MMM HH:mm"


def published_with_latest(points: DataFrame, as_of: Column) -> DataFrame:
    published = points.where(F.col("delivery_ts") <= as_of)
    latest = published.groupBy("region").agg(F.max("delivery_ts").alias("latest"))
    return published.join(latest, on="region")


def _in_days(days: int) -> Column:
    return F.col("delivery_ts") > F.col("latest") - F.make_dt_interval(F.lit(days))


def recent(points: DataFrame, as_of: Column, days: int = max(PULSE_WINDOWS)) -> DataFrame:
    return published_with_latest(points, as_of).where(_in_days(days))


def windows(points: DataFrame, as_of: Column, window_days=PULSE_WINDOWS) -> DataFrame:
    """Hours, rounded average, min, max, negative hours and share per
    (region, window). An empty window has no row."""
    rows = recent(points, as_of, max(window_days))
    days = F.array(*[F.lit(d) for d in window_days])
    exploded = rows.select(
        "region",
        "price_eur_mwh",
        F.explode(
            F.filter(days, lambda d: F.col("delivery_ts") > F.col("latest") - F.make_dt_interval(d))
        ).alias("window_days"),
    )
    c = exact("price_eur_mwh")
    neg = F.count_if(F.col("price_eur_mwh") < 0)
    return exploded.groupBy("region", "window_days").agg(
        F.count(c).alias("hours"),
        avg_exact_price(F.sum(c), F.count(c)).alias("avg_price"),
        to_cents(F.min(c)).alias("min_price"),
        to_cents(F.max(c)).alias("max_price"),
        neg.alias("negative_hours"),
        pct1(neg, F.count(c)).alias("negative_share"),
    )


def extremes(points: DataFrame, as_of: Column, days: int = max(PULSE_WINDOWS)) -> DataFrame:
    """Cheapest and priciest hour of the window by raw price; ties go to the earliest hour."""
    c = exact("price_eur_mwh")
    low = F.min(F.struct(c.alias("c"), F.col("delivery_ts").alias("ts")))
    high = F.min(F.struct((-c).alias("c"), F.col("delivery_ts").alias("ts")))
    agg = recent(points, as_of, days).groupBy("region").agg(low.alias("low"), high.alias("high"))
    return agg.select(
        "region",
        F.col("low.ts").alias("cheapest_ts"),
        F.date_format(local_ts(F.col("low.ts")), LOCAL_PATTERN).alias("cheapest_local"),
        to_cents(F.col("low.c")).alias("cheapest_price"),
        F.col("high.ts").alias("priciest_ts"),
        F.date_format(local_ts(F.col("high.ts")), LOCAL_PATTERN).alias("priciest_local"),
        to_cents(-F.col("high.c")).alias("priciest_price"),
    )


def split(points: DataFrame, as_of: Column, days: int = max(PULSE_WINDOWS)) -> DataFrame:
    """Weekday and weekend mean and count over the window; both rows are
    always present (mean NULL when there is no hour)."""
    c = exact("price_eur_mwh")
    weekend = F.dayofweek(local_ts("delivery_ts")).isin(1, 7)
    agg = recent(points, as_of, days).groupBy("region").agg(
        F.sum(F.when(~weekend, c)).alias("wd_sum"),
        F.count(F.when(~weekend, c)).alias("wd_n"),
        F.sum(F.when(weekend, c)).alias("we_sum"),
        F.count(F.when(weekend, c)).alias("we_n"),
    )
    both = F.array(
        F.struct(F.lit("weekday").alias("daytype"), F.col("wd_sum").alias("s"), F.col("wd_n").alias("n")),
        F.struct(F.lit("weekend").alias("daytype"), F.col("we_sum").alias("s"), F.col("we_n").alias("n")),
    )
    return agg.select("region", F.inline(both)).select(
        "region", "daytype", avg_exact_price(F.col("s"), F.col("n")).alias("avg_price"), F.col("n").alias("hours")
    )
