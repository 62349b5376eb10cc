"""BI statements and dashboard panels as SQL over stored serving tables.

``register`` puts temporary views over the serving tables of a lake, and the SQL function
``rounded_ratio``; ``run`` answers a named statement with typed parameters (never spliced
text). The statements read what the transform job stored: no event is parsed, deduplicated
or regrouped again, and a time range prunes the day partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake import lake as L
from gridlake.plans import bi, dashboard  # noqa: F401  (bi registers its oracles)
from gridlake.plans import lake as stored
from gridlake.plans.registry import _QUERIES, query
from gridlake.schemas import EVENING, LOCAL_TZ, MIDDAY, SERVING_DAILY, SERVING_HOURLY
from gridlake.session import ensure_utc
from gridlake.sinks import tables as TB
from gridlake.sources import fixtures as X

HOURLY_VIEW, DAILY_VIEW = "serving_hours", "serving_days"

#: Half away from zero, on integers; NULL without a denominator. ``num`` is already scaled.
_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION rounded_ratio(num BIGINT, den BIGINT, digits INT) RETURNS DOUBLE
RETURN IF(den > 0, CAST(sign(num) * ((2 * abs(num) + den) DIV (2 * den)) AS DOUBLE) / power(10, digits), NULL)
"""

_MID = f"local_hour BETWEEN {MIDDAY[0]} AND {MIDDAY[1]}"
_EVE = f"local_hour BETWEEN {EVENING[0]} AND {EVENING[1]}"
_IN = "(:region IS NULL OR region = :region)"
_RANGE = (
    f"delivery_ts BETWEEN CAST(:as_of AS TIMESTAMP) - INTERVAL {dashboard.RANGE_BACK_DAYS} DAY"
    f" AND CAST(:as_of AS TIMESTAMP) + INTERVAL {dashboard.RANGE_AHEAD_DAYS} DAY"
    # Implied by the row predicate; stated so that other days' folders are not listed.
    f" AND delivery_date BETWEEN date_sub(CAST(:as_of AS TIMESTAMP), {dashboard.RANGE_BACK_DAYS})"
    f" AND date_add(CAST(:as_of AS TIMESTAMP), {dashboard.RANGE_AHEAD_DAYS})"
)


def _avg(cond: str | None = None) -> str:
    only = f" FILTER (WHERE {cond})" if cond else ""
    return f"rounded_ratio(sum(price_cents){only}, count(price_cents){only}, 2)"


_NEGATIVE = "count_if(is_negative)"
_PERCENT = f"rounded_ratio({_NEGATIVE} * 1000, count(*), 1)"
_EXACT = "CAST(sum(price_cents) AS DOUBLE) / (CAST(count(price_cents) AS DOUBLE) * 100)"
_MIDDAYS = f"SELECT local_day, {_avg()} AS midday_avg FROM {HOURLY_VIEW} WHERE {_IN} AND is_weekend AND {_MID} GROUP BY local_day"

#: Statement name -> SQL with the parameters :region (NULL: all) and, for panels, :as_of.
STATEMENTS = {
    "bi_hour_profile": f"""
        SELECT local_hour, {_avg()} AS avg_price, count(*) AS n FROM {HOURLY_VIEW} WHERE {_IN}
        GROUP BY local_hour ORDER BY local_hour""",
    "bi_peak_trough": f"""
        SELECT {_avg(_EVE)} AS evening_peak, {_avg(_MID)} AS midday_trough FROM {HOURLY_VIEW} WHERE {_IN}""",
    "bi_negative_totals": f"""
        SELECT {_NEGATIVE} AS neg_hours, count(*) AS total_hours, {_PERCENT} AS pct_negative,
               min(price_cents) / 100D AS min_price, max(price_cents) / 100D AS max_price, {_avg()} AS avg_price
        FROM {HOURLY_VIEW} WHERE {_IN}""",
    "bi_negative_by_daytype": f"""
        SELECT is_weekend, {_NEGATIVE} AS neg_hours, count(*) AS total, {_PERCENT} AS pct
        FROM {HOURLY_VIEW} WHERE {_IN} GROUP BY is_weekend ORDER BY is_weekend""",
    "bi_monthly": f"""
        SELECT substr(local_day, 1, 7) AS month, {_NEGATIVE} AS neg_hours, count(*) AS hours, {_avg()} AS avg_price,
               min(price_cents) / 100D AS min_price
        FROM {HOURLY_VIEW} WHERE {_IN} GROUP BY 1 ORDER BY 1""",
    "bi_avg_by_daytype": f"""
        SELECT is_weekend, {_avg()} AS avg_price, count(*) AS n FROM {HOURLY_VIEW} WHERE {_IN}
        GROUP BY is_weekend ORDER BY is_weekend""",
    "bi_band_by_daytype": f"""
        SELECT is_weekend, {_MID} AS midday, {_avg()} AS avg_price, count(*) AS n
        FROM {HOURLY_VIEW} WHERE {_IN} AND ({_MID} OR {_EVE}) GROUP BY 1, 2 ORDER BY 1, 2""",
    "bi_daily_spread": f"""
        SELECT rounded_ratio(sum(spread), count(spread), 2) AS avg_daily_spread FROM (
            SELECT max(price_cents) - min(price_cents) AS spread FROM {HOURLY_VIEW} WHERE {_IN} GROUP BY local_day)""",
    "bi_negative_days": f"""
        SELECT count_if(negative_hours > 0) AS days_with_neg, max(negative_hours) AS max_neg_hours_in_day
        FROM {DAILY_VIEW} WHERE {_IN}""",
    "bi_worst_days": f"""
        SELECT local_day, avg_price, min_price, max_price, negative_hours FROM {DAILY_VIEW} WHERE {_IN}
        ORDER BY negative_hours DESC NULLS FIRST, local_day, region LIMIT 3""",
    "bi_weekend_midday": f"{_MIDDAYS} ORDER BY midday_avg DESC NULLS FIRST",
    "bi_weekend_midday_below_zero": f"""
        SELECT count(*) AS days, count_if(midday_avg < 0) AS days_below_zero FROM ({_MIDDAYS})""",
    "dash_newest_hour": f"""
        SELECT price_eur_mwh AS price FROM {HOURLY_VIEW} WHERE {_IN} ORDER BY delivery_ts DESC LIMIT 1""",
    "dash_range_stats": f"""
        SELECT {_EXACT} AS average, {_NEGATIVE} AS hours FROM {HOURLY_VIEW} WHERE {_IN} AND {_RANGE}""",
    "dash_price_series": f"""
        SELECT delivery_ts AS time, price_eur_mwh AS price FROM {HOURLY_VIEW} WHERE {_IN} AND {_RANGE} ORDER BY time""",
    "dash_last_days": f"""
        SELECT date_format(local_day, 'EEE dd') AS day, negative_hours AS hours_below_zero FROM (
            SELECT local_day, negative_hours FROM {DAILY_VIEW} WHERE {_IN} ORDER BY local_day DESC LIMIT 14)
        ORDER BY local_day""",
    "dash_hour_profile": f"""
        SELECT lpad(local_hour, 2, '0') || ':00' AS hour, {_EXACT} AS average_price
        FROM {HOURLY_VIEW} WHERE {_IN} AND {_RANGE} GROUP BY local_hour ORDER BY local_hour""",
}


def register(spark: SparkSession, lake: L.Lake) -> None:
    """Views over the lake's serving tables (empty ones before the first transform) for this session."""
    ensure_utc(spark)
    hours = TB.read_table(spark, lake.path(L.SERVING_HOURLY), L.stored(SERVING_HOURLY, L.SERVING_HOURLY))
    hours.selectExpr(
        "region", "delivery_ts", "delivery_date", "price_eur_mwh", "CAST(price_eur_mwh * 100 AS BIGINT) AS price_cents",
        "local_hour", "is_weekend", "is_negative",
        f"date_format(from_utc_timestamp(delivery_ts, '{LOCAL_TZ}'), 'yyyy-MM-dd') AS local_day",
    ).createOrReplaceTempView(HOURLY_VIEW)
    TB.read_table(spark, lake.path(L.SERVING_DAILY), SERVING_DAILY).createOrReplaceTempView(DAILY_VIEW)
    spark.sql(_FUNCTION)


def run(spark: SparkSession, statement: str, region: str | None = None, as_of: str | None = None) -> DataFrame:
    """A statement over the registered views; ``region`` None: every region."""
    text = STATEMENTS[statement]
    args = {k: v for k, v in (("region", region), ("as_of", as_of)) if f":{k}" in text}
    if args.get("as_of", "") is None:
        raise ValueError(f"{statement} is a panel over a stretch of time: it needs as_of")
    return spark.sql(text, args=args)


_SERVED: dict[tuple[str, str], L.Lake] = {}


def served(spark: SparkSession, sf_dir: str) -> L.Lake:
    """The lake that the jobs made of ``sf_dir``: written once an application, read by every statement."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SERVED or not TB.has_data(spark, _SERVED[key].path(L.SERVING_DAILY)):
        _SERVED[key] = stored.loaded(spark, sf_dir)
    return _SERVED[key]


def _over_views(statement: str):
    region = X.DASHBOARD_REGION if statement.startswith("dash_") else None

    def answer(spark, sf_dir):
        register(spark, served(spark, sf_dir))
        return run(spark, statement, region, X.AS_OF)

    answer.__doc__ = f"S9: {statement} as SQL over the stored serving tables."
    return answer


for _name in STATEMENTS:
    query(f"view_{_name}", _QUERIES[_name].sql)(_over_views(_name))
