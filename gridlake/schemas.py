"""Table schemas and fixed domain constants."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values (must equal the market's conventions) ---------------------
# Local market time zone, DST-aware.
LOCAL_TZ = "Europe/Berlin"
# Hour bands of the analysis, both ends inclusive (local hours).
MIDDAY = (11, 14)
EVENING = (18, 20)
# Pulse windows in days, counted back from the newest published hour.
PULSE_WINDOWS = (1, 7, 14)
# From this local hour on, every hour of the current local day is due in serving.
TODAY_DUE_FROM_HOUR = 5
# Last delivery hour of a local day that must be present.
DUE_LOCAL_HOUR = 23
# Classifier label that means "not about energy".
NONE_LABEL = "none of these"
# Zone abbreviations of Europe/Berlin by UTC offset in hours.
ZONE_ABBREVIATION = {1: "CET", 2: "CEST"}
# Week chunks start on Monday 00:00 local time.
# -----------------------------------------------------------------------------

KEYS = ("region", "delivery_ts")
NEWS_KEYS = ("source", "link")

MESSAGE = StructType(
    [
        StructField("region", StringType()),
        StructField("delivery_ts", StringType()),
        StructField("price_eur_mwh", DoubleType()),
        StructField("source", StringType()),
        StructField("fetched_at", StringType()),
    ]
)

BRONZE = StructType(
    [
        StructField("region", StringType()),
        StructField("delivery_ts", TimestampType()),
        StructField("price_eur_mwh", DoubleType()),
        StructField("source", StringType()),
        StructField("fetched_at", TimestampType()),
    ]
)

SILVER = StructType(
    [
        StructField("region", StringType()),
        StructField("delivery_ts", TimestampType()),
        StructField("price_eur_mwh", DoubleType()),
        StructField("local_ts", TimestampType()),
        StructField("local_hour", IntegerType()),
        StructField("is_weekend", BooleanType()),
        StructField("is_negative", BooleanType()),
        StructField("source", StringType()),
        StructField("updated_at", TimestampType()),
    ]
)

GOLD_DAILY = StructType(
    [
        StructField("region", StringType()),
        StructField("local_day", DateType()),
        StructField("avg_price", DoubleType()),
        StructField("min_price", DoubleType()),
        StructField("max_price", DoubleType()),
        StructField("negative_hours", IntegerType()),
        StructField("updated_at", TimestampType()),
    ]
)

NEWS = StructType(
    [
        StructField("source", StringType()),
        StructField("link", StringType()),
        StructField("title", StringType()),
        StructField("published_ts", TimestampType()),
        StructField("category", StringType()),
        StructField("confidence", DoubleType()),
        StructField("model", StringType()),
        StructField("fetched_at", TimestampType()),
    ]
)

MONEY = DecimalType(10, 2)

SERVING_HOURLY = StructType(
    [
        StructField("region", StringType()),
        StructField("delivery_ts", TimestampType()),
        StructField("price_eur_mwh", MONEY),
        StructField("local_hour", IntegerType()),
        StructField("is_weekend", BooleanType()),
        StructField("is_negative", BooleanType()),
        StructField("updated_at", TimestampType()),
    ]
)

SERVING_DAILY = StructType(
    [
        StructField("region", StringType()),
        StructField("local_day", DateType()),
        StructField("avg_price", MONEY),
        StructField("min_price", MONEY),
        StructField("max_price", MONEY),
        StructField("negative_hours", IntegerType()),
        StructField("updated_at", TimestampType()),
    ]
)

PIPELINE_HEALTH = StructType(
    [
        StructField("check_name", StringType()),
        StructField("status", StringType()),
        StructField("detail", StringType()),
        StructField("checked_at", TimestampType()),
    ]
)

# The change log of bronze: a row per merge and day that it touched.
CHANGES = StructType(
    [
        StructField("entry_id", StringType()),
        StructField("delivery_date", DateType()),
        StructField("newest", TimestampType()),
        StructField("logged_day", DateType()),
    ]
)
