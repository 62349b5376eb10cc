"""Dashboard panels and chart series over the serving tables.

Dashboard panels filter one region and a time range (the dashboard's default
range is ``now - 7 days`` to ``now + 1 day``; ``now`` is the run's ``as_of``).
Chart series are unrounded averages: one correctly rounded division of an
integer cent sum by a count, so they are exact and engine-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.money import avg_price_exact, cents
from gridlake.functions.time import hour_between, local_ts
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import MIDDAY
from gridlake.sources.fixtures import DASHBOARD_REGION



def _c():
    return cents("price_eur_mwh")


_WITH = S.with_(*S.SERVING_CTES)
_DAILY = S.with_(*S.DAILY_CTES)
RANGE_BACK_DAYS = 7
RANGE_AHEAD_DAYS = 1
_R = f"region = '{DASHBOARD_REGION}'"
_RANGE_SQL = (
    f"delivery_ts BETWEEN {S.AS_OF_SQL} - INTERVAL {RANGE_BACK_DAYS} DAY AND {S.AS_OF_SQL} + INTERVAL {RANGE_AHEAD_DAYS} DAY"
)


def time_range(as_of: Column, back_days: int = RANGE_BACK_DAYS, ahead_days: int = RANGE_AHEAD_DAYS) -> Column:
    return F.col("delivery_ts").between(
        as_of - F.make_dt_interval(F.lit(back_days)), as_of + F.make_dt_interval(F.lit(ahead_days))
    )


def _panel(spark, sf_dir, region: str = DASHBOARD_REGION, ranged: bool = True) -> DataFrame:
    if not ranged:
        return state.serving(spark, sf_dir).where(F.col("region") == region)
    as_of = state.as_of()
    since, through = as_of - F.make_dt_interval(F.lit(RANGE_BACK_DAYS)), as_of + F.make_dt_interval(F.lit(RANGE_AHEAD_DAYS))
    served = state.serving(spark, sf_dir, since=since, through=through)
    return served.where((F.col("region") == region) & time_range(as_of))


def _exact_avg(cond: Column | None = None) -> Column:
    if cond is None:
        return avg_price_exact(F.sum(_c()), F.count(_c()))
    return avg_price_exact(F.sum(F.when(cond, _c())), F.count(F.when(cond, _c())))


def _sql_exact(cond: str | None = None) -> str:
    if cond is None:
        return S.avg_exact()
    return S.avg_exact(f"sum(price_cents) FILTER (WHERE {cond})", f"count(price_cents) FILTER (WHERE {cond})")


@query(
    "dash_newest_hour",
    _WITH + f"SELECT price_eur_mwh AS price FROM serving WHERE {_R} ORDER BY delivery_ts DESC LIMIT 1",
)
def dash_newest_hour(spark, sf_dir):
    """Newest hour's price (top-1 by delivery time)."""
    return (
        _panel(spark, sf_dir, ranged=False)
        .orderBy(F.col("delivery_ts").desc())
        .limit(1)
        .select(F.col("price_eur_mwh").alias("price"))
    )


@query(
    "dash_range_stats",
    _WITH
    + f"""SELECT {_sql_exact()} AS average, count(*) FILTER (WHERE is_negative) AS hours
FROM serving WHERE {_R} AND {_RANGE_SQL}""",
)
def dash_range_stats(spark, sf_dir):
    """Average price and hours below zero over the selected range."""
    return _panel(spark, sf_dir).agg(_exact_avg().alias("average"), F.count_if(F.col("is_negative")).alias("hours"))


@query(
    "dash_price_series",
    _WITH + f"SELECT delivery_ts AS time, price_eur_mwh AS price FROM serving WHERE {_RANGE_SQL} AND {_R}",
)
def dash_price_series(spark, sf_dir):
    """Hourly price series over the range, ascending."""
    return (
        _panel(spark, sf_dir)
        .select(F.col("delivery_ts").alias("time"), F.col("price_eur_mwh").alias("price"))
        .orderBy("time")
    )


@query(
    "dash_last_days",
    _DAILY
    + f"""SELECT strftime(local_day, '%a %d') AS day, negative_hours AS hours_below_zero FROM (
    SELECT local_day, negative_hours FROM daily WHERE {_R} ORDER BY local_day DESC LIMIT 14) newest""",
)
def dash_last_days(spark, sf_dir):
    """Hours below zero per day for the latest 14 days, labelled ``Dy DD``."""
    last = (
        state.daily(spark, sf_dir)
        .where(F.col("region") == DASHBOARD_REGION)
        .orderBy(F.col("local_day").desc())
        .limit(14)
    )
    return last.orderBy("local_day").select(
        F.date_format("local_day", "EEE dd").alias("day"),
        F.col("negative_hours").alias("hours_below_zero"),
    )


@query(
    "dash_hour_profile",
    _WITH
    + f"""SELECT lpad(CAST(local_hour AS VARCHAR), 2, '0') || ':00' AS hour, {_sql_exact()} AS average_price
FROM serving WHERE {_R} AND {_RANGE_SQL} GROUP BY local_hour""",
)
def dash_hour_profile(spark, sf_dir):
    """Average price by local hour over the range, labelled ``HH:00``."""
    return (
        _panel(spark, sf_dir)
        .groupBy("local_hour")
        .agg(_exact_avg().alias("average_price"))
        .orderBy("local_hour")
        .select(F.concat(F.lpad(F.col("local_hour").cast("string"), 2, "0"), F.lit(":00")).alias("hour"), "average_price")
    )


_LOCAL_DATE_SQL = f"CAST({S.local('delivery_ts')} AS DATE)"


def data_window_frame(serving: DataFrame) -> DataFrame:
    day = F.to_date(local_ts("delivery_ts"))
    return serving.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("hours"))


@query(
    "data_window",
    _WITH + f"SELECT min({_LOCAL_DATE_SQL}) AS first_day, max({_LOCAL_DATE_SQL}) AS last_day, count(*) AS hours FROM serving",
)
def data_window(spark, sf_dir):
    """First and last local day of the data, and the number of hours."""
    return data_window_frame(state.serving(spark, sf_dir))


@query(
    "week_rhythm",
    _WITH
    + f"""SELECT local_hour, {_sql_exact('NOT is_weekend')} AS weekday_avg, {_sql_exact('is_weekend')} AS weekend_avg
FROM serving GROUP BY local_hour""",
)
def week_rhythm(spark, sf_dir):
    """Average by local hour, weekday and weekend side by side."""
    return (
        state.serving(spark, sf_dir)
        .groupBy("local_hour")
        .agg(_exact_avg(~F.col("is_weekend")).alias("weekday_avg"), _exact_avg(F.col("is_weekend")).alias("weekend_avg"))
        .orderBy("local_hour")
    )


@query(
    "weekend_midday_avg",
    _WITH
    + f"SELECT {_sql_exact()} AS weekend_midday_avg FROM serving WHERE is_weekend AND local_hour BETWEEN {MIDDAY[0]} AND {MIDDAY[1]}",
)
def weekend_midday_avg(spark, sf_dir):
    """Weekend midday average (scalar)."""
    return (
        state.serving(spark, sf_dir)
        .where(F.col("is_weekend") & hour_between("local_hour", MIDDAY))
        .agg(_exact_avg().alias("weekend_midday_avg"))
    )


@query(
    "monthly_series",
    _WITH
    + f"""SELECT m.month, m.neg_hours, m.avg_price,
       (m.month = strftime(w.first_day, '%Y-%m') AND day(w.first_day) > 1)
       OR (m.month = strftime(w.last_day, '%Y-%m') AND w.last_day < last_day(w.last_day)) AS partial
FROM (SELECT strftime({S.local('delivery_ts')}, '%Y-%m') AS month,
             count(*) FILTER (WHERE is_negative) AS neg_hours, {_sql_exact()} AS avg_price
      FROM serving GROUP BY 1) m
CROSS JOIN (SELECT min({_LOCAL_DATE_SQL}) AS first_day, max({_LOCAL_DATE_SQL}) AS last_day FROM serving) w""",
)
def monthly_series(spark, sf_dir):
    """Monthly negative hours and unrounded average, with partial-month flags
    for the first and last month of the data window."""
    serving = state.serving(spark, sf_dir)
    day = F.to_date(local_ts("delivery_ts"))
    monthly = serving.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.count_if(F.col("is_negative")).alias("neg_hours"),
        _exact_avg().alias("avg_price"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
    # The window bounds come from the monthly rows themselves: a window over
    # one row per month, so no second scan and no join.
    every_month = Window.partitionBy()
    first_day = F.min("first_day").over(every_month)
    last_day = F.max("last_day").over(every_month)
    partial = ((F.col("first_day") == first_day) & (F.dayofmonth(first_day) > 1)) | (
        (F.col("last_day") == last_day) & (last_day < F.last_day(last_day))
    )
    return monthly.select("month", "neg_hours", "avg_price", partial.alias("partial")).orderBy("month")


@query(
    "profile_extremes",
    _WITH
    + f"""SELECT arg_min(local_hour, [avg_price, local_hour]) AS low_hour, min(avg_price) AS low_avg,
       arg_min(local_hour, [-avg_price, local_hour]) AS high_hour, max(avg_price) AS high_avg
FROM (SELECT local_hour, {_sql_exact()} AS avg_price FROM serving GROUP BY local_hour) p""",
)
def profile_extremes(spark, sf_dir):
    """Lowest and highest hour of the unrounded hour profile (first on ties)."""
    profile = state.serving(spark, sf_dir).groupBy("local_hour").agg(_exact_avg().alias("avg_price"))
    low = F.min(F.struct("avg_price", "local_hour"))
    high = F.min(F.struct((-F.col("avg_price")).alias("neg"), F.col("local_hour")))
    return profile.agg(low.alias("low"), high.alias("high"), F.max("avg_price").alias("high_avg")).select(
        F.col("low.local_hour").alias("low_hour"),
        F.col("low.avg_price").alias("low_avg"),
        F.col("high.local_hour").alias("high_hour"),
        "high_avg",
    )
