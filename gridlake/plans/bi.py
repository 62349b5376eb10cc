"""BI statements over the serving tables (one query each).

They read every region, as the reference's BI SQL does. Each statement is a
function of the serving (or daily) DataFrame; ``for_region`` gives the
single-zone variant. Averages are rounded to cents
and percentages to one decimal, half away from zero, from integer sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.money import avg_price, cents, cents_to_price, pct1
from gridlake.functions.time import hour_between
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import EVENING, MIDDAY



def _c():
    return cents("price_eur_mwh")


_WITH = S.with_(*S.SERVING_CTES)
_DAILY = S.with_(*S.DAILY_CTES)


def for_region(df: DataFrame, region: str | None) -> DataFrame:
    """The single-zone variant of any statement: filter serving rows first."""
    return df if region is None else df.where(F.col("region") == region)


def _avg(cond: Column | None = None) -> tuple[Column, Column]:
    """(sum of cents, count) under an optional FILTER condition."""
    if cond is None:
        return F.sum(_c()), F.count(_c())
    return F.sum(F.when(cond, _c())), F.count(F.when(cond, _c()))


def _rounded_avg(cond: Column | None = None) -> Column:
    s, n = _avg(cond)
    return avg_price(s, n)


def hour_profile(serving: DataFrame) -> DataFrame:
    return (
        serving.groupBy("local_hour")
        .agg(_rounded_avg().alias("avg_price"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "bi_hour_profile",
    _WITH + f"SELECT local_hour, {S.avg2()} AS avg_price, count(*) AS n FROM serving GROUP BY local_hour",
)
def bi_hour_profile(spark, sf_dir):
    """Mean price and number of hours for each local hour."""
    return hour_profile(state.serving(spark, sf_dir)).orderBy("local_hour")


_MID = f"local_hour BETWEEN {MIDDAY[0]} AND {MIDDAY[1]}"
_EVE = f"local_hour BETWEEN {EVENING[0]} AND {EVENING[1]}"


def _sql_avg_filtered(cond: str) -> str:
    return S.avg2(
        f"sum(price_cents) FILTER (WHERE {cond})", f"count(price_cents) FILTER (WHERE {cond})"
    )


@query(
    "bi_peak_trough",
    _WITH + f"SELECT {_sql_avg_filtered(_EVE)} AS evening_peak, {_sql_avg_filtered(_MID)} AS midday_trough FROM serving",
)
def bi_peak_trough(spark, sf_dir):
    """One row: mean of the evening band, of the midday band, and their distance."""
    return peak_trough(state.serving(spark, sf_dir))


def peak_trough(serving: DataFrame) -> DataFrame:
    return serving.agg(
        _rounded_avg(hour_between("local_hour", EVENING)).alias("evening_peak"),
        _rounded_avg(hour_between("local_hour", MIDDAY)).alias("midday_trough"),
    )


@query(
    "bi_negative_totals",
    _WITH
    + f"""SELECT count(*) FILTER (WHERE is_negative) AS neg_hours, count(*) AS total_hours,
       {S.pct1('count(*) FILTER (WHERE is_negative)', 'count(*)')} AS pct_negative,
       {S.price('min(price_cents)')} AS min_price, {S.price('max(price_cents)')} AS max_price,
       {S.avg2()} AS avg_price
FROM serving""",
)
def bi_negative_totals(spark, sf_dir):
    """Hours below zero in total; without rows the ratios are NULL."""
    return negative_totals(state.serving(spark, sf_dir))


def negative_totals(serving: DataFrame) -> DataFrame:
    neg = F.count_if(F.col("is_negative"))
    total = F.count(F.lit(1))
    return serving.agg(
        neg.alias("neg_hours"),
        total.alias("total_hours"),
        pct1(neg, total).alias("pct_negative"),
        cents_to_price(F.min(_c())).alias("min_price"),
        cents_to_price(F.max(_c())).alias("max_price"),
        _rounded_avg().alias("avg_price"),
    )


@query(
    "bi_negative_by_daytype",
    _WITH
    + f"""SELECT is_weekend, count(*) FILTER (WHERE is_negative) AS neg_hours, count(*) AS total,
       {S.pct1('count(*) FILTER (WHERE is_negative)', 'count(*)')} AS pct
FROM serving GROUP BY is_weekend""",
)
def bi_negative_by_daytype(spark, sf_dir):
    """Share of hours below zero by kind of day."""
    return negative_by_daytype(state.serving(spark, sf_dir))


def negative_by_daytype(serving: DataFrame) -> DataFrame:
    neg = F.count_if(F.col("is_negative"))
    total = F.count(F.lit(1))
    return (
        serving.groupBy("is_weekend")
        .agg(neg.alias("neg_hours"), total.alias("total"), pct1(neg, total).alias("pct"))
        .orderBy("is_weekend")
    )


@query(
    "bi_monthly",
    _WITH
    + f"""SELECT strftime({S.local('delivery_ts')}, '%Y-%m') AS month,
       count(*) FILTER (WHERE is_negative) AS neg_hours, count(*) AS hours,
       {S.avg2()} AS avg_price, {S.price('min(price_cents)')} AS min_price
FROM serving GROUP BY 1""",
)
def bi_monthly(spark, sf_dir):
    """Mean, lowest and highest price of each local month."""
    return monthly(state.serving(spark, sf_dir))


def monthly(serving: DataFrame) -> DataFrame:
    return (
        serving.groupBy(F.date_format(F.from_utc_timestamp("delivery_ts", "Europe/Berlin"), "yyyy-MM").alias("month"))
        .agg(
            F.count_if(F.col("is_negative")).alias("neg_hours"),
            F.count(F.lit(1)).alias("hours"),
            _rounded_avg().alias("avg_price"),
            cents_to_price(F.min(_c())).alias("min_price"),
        )
        .orderBy("month")
    )


@query(
    "bi_avg_by_daytype",
    _WITH + f"SELECT is_weekend, {S.avg2()} AS avg_price, count(*) AS n FROM serving GROUP BY is_weekend",
)
def bi_avg_by_daytype(spark, sf_dir):
    """Mean price by kind of day."""
    return avg_by_daytype(state.serving(spark, sf_dir))


def avg_by_daytype(serving: DataFrame) -> DataFrame:
    return (
        serving.groupBy("is_weekend")
        .agg(_rounded_avg().alias("avg_price"), F.count(F.lit(1)).alias("n"))
        .orderBy("is_weekend")
    )


@query(
    "bi_band_by_daytype",
    _WITH
    + f"""SELECT is_weekend, ({_MID}) AS midday, {S.avg2()} AS avg_price, count(*) AS n
FROM serving WHERE ({_MID}) OR ({_EVE}) GROUP BY 1, 2""",
)
def bi_band_by_daytype(spark, sf_dir):
    """Mean price by kind of day and band (midday or evening hours only)."""
    return band_by_daytype(state.serving(spark, sf_dir))


def band_by_daytype(serving: DataFrame) -> DataFrame:
    mid = hour_between("local_hour", MIDDAY)
    return (
        serving.where(mid | hour_between("local_hour", EVENING))
        .groupBy("is_weekend", mid.alias("midday"))
        .agg(_rounded_avg().alias("avg_price"), F.count(F.lit(1)).alias("n"))
        .orderBy("is_weekend", "midday")
    )


@query(
    "bi_daily_spread",
    _WITH
    + f"""SELECT {S.avg2('sum(spread)', 'count(spread)')} AS avg_daily_spread FROM (
    SELECT strftime({S.local('delivery_ts')}, '%Y-%m-%d') AS d, max(price_cents) - min(price_cents) AS spread
    FROM serving GROUP BY 1) daily""",
)
def bi_daily_spread(spark, sf_dir):
    """Mean distance between a local day's dearest and cheapest hour."""
    return daily_spread(state.serving(spark, sf_dir))


def daily_spread(serving: DataFrame) -> DataFrame:
    per_day = (
        serving.groupBy(F.date_format(F.from_utc_timestamp("delivery_ts", "Europe/Berlin"), "yyyy-MM-dd").alias("d"))
        .agg((F.max(_c()) - F.min(_c())).alias("spread"))
    )
    return per_day.agg(avg_price(F.sum("spread"), F.count("spread")).alias("avg_daily_spread"))


@query(
    "bi_negative_days",
    _DAILY
    + """SELECT count(*) FILTER (WHERE negative_hours > 0) AS days_with_neg,
       max(negative_hours) AS max_neg_hours_in_day FROM daily""",
)
def bi_negative_days(spark, sf_dir):
    """How many days had hours below zero, and the most such hours in a day."""
    return negative_days(state.daily(spark, sf_dir))


def negative_days(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count_if(F.col("negative_hours") > 0).alias("days_with_neg"),
        F.max("negative_hours").alias("max_neg_hours_in_day"),
    )


@query(
    "bi_worst_days",
    _DAILY
    + """SELECT local_day, avg_price, min_price, max_price, negative_hours FROM daily
ORDER BY negative_hours DESC NULLS FIRST, local_day, region LIMIT 3""",
)
def bi_worst_days(spark, sf_dir):
    """The three days with the most negative hours (top-k; NULLs first as in
    the reference's database, ties by day then region)."""
    return worst_days(state.daily(spark, sf_dir))


def worst_days(daily: DataFrame, n: int = 3) -> DataFrame:
    return (
        daily.orderBy(F.col("negative_hours").desc_nulls_first(), "local_day", "region")
        .limit(n)
        .select("local_day", "avg_price", "min_price", "max_price", "negative_hours")
    )


@query(
    "bi_weekend_midday",
    _WITH
    + f"""SELECT strftime({S.local('delivery_ts')}, '%Y-%m-%d') AS local_day, {S.avg2()} AS midday_avg
FROM serving WHERE is_weekend AND {_MID} GROUP BY 1""",
)
def bi_weekend_midday(spark, sf_dir):
    """Midday mean of every weekend day, dearest first."""
    return weekend_midday(state.serving(spark, sf_dir))


def weekend_midday(serving: DataFrame) -> DataFrame:
    return (
        serving.where(F.col("is_weekend") & hour_between("local_hour", MIDDAY))
        .groupBy(F.date_format(F.from_utc_timestamp("delivery_ts", "Europe/Berlin"), "yyyy-MM-dd").alias("local_day"))
        .agg(_rounded_avg().alias("midday_avg"))
        .orderBy(F.col("midday_avg").desc_nulls_first())
    )


@query(
    "bi_weekend_midday_below_zero",
    _WITH
    + f"""SELECT count(*) AS days, count(*) FILTER (WHERE midday_avg < 0) AS days_below_zero FROM (
    SELECT strftime({S.local('delivery_ts')}, '%Y-%m-%d') AS local_day, {S.avg2()} AS midday_avg
    FROM serving WHERE is_weekend AND {_MID} GROUP BY 1) daily""",
)
def bi_weekend_midday_below_zero(spark, sf_dir):
    """Weekend days, and how many of them have a midday mean below zero."""
    per_day = weekend_midday(state.serving(spark, sf_dir))
    return per_day.agg(
        F.count(F.lit(1)).alias("days"), F.count_if(F.col("midday_avg") < 0).alias("days_below_zero")
    )
