"""Market pulse and the freshness check, per region, at the run's ``as_of``."""

from __future__ import annotations

from gridlake.operators import health, pulse
from gridlake.operators.revisions import latest_revision
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import KEYS, PULSE_WINDOWS

_WINDOWS_SQL = ", ".join(f"({d})" for d in PULSE_WINDOWS)
_PULSE_CTES = S.with_(
    ("obs", S.obs()),
    ("latest", S.latest()),
    ("pub", f"SELECT region, delivery_ts, price_cents, price_eur_mwh FROM latest WHERE delivery_ts <= {S.AS_OF_SQL}"),
    ("lt", "SELECT region, max(delivery_ts) AS latest_ts FROM pub GROUP BY region"),
    (
        "w",
        f"""SELECT p.*, d.window_days FROM pub p JOIN lt USING (region)
        JOIN (VALUES {_WINDOWS_SQL}) d(window_days) ON p.delivery_ts > lt.latest_ts - d.window_days * INTERVAL 1 DAY""",
    ),
    ("w14", f"SELECT * FROM w WHERE window_days = {max(PULSE_WINDOWS)}"),
)


def _points(spark, sf_dir):
    bronze = state.bronze(spark, sf_dir, through=state.as_of())
    return latest_revision(bronze, KEYS).select("region", "delivery_ts", "price_eur_mwh")


_NEG = "count(*) FILTER (WHERE price_eur_mwh < 0)"


@query(
    "pulse_windows",
    _PULSE_CTES
    + f"""SELECT region, window_days, count(price_cents) AS hours, {S.avg2()} AS avg_price,
       {S.price('min(price_cents)')} AS min_price, {S.price('max(price_cents)')} AS max_price,
       {_NEG} AS negative_hours, {S.pct1(_NEG, 'count(price_cents)')} AS negative_share
FROM w GROUP BY region, window_days""",
)
def pulse_windows(spark, sf_dir):
    """1/7/14-day windows from the newest published hour of each region."""
    return pulse.windows(_points(spark, sf_dir), state.as_of())


_LOCAL_FMT = "'%a %d %b %H:%M'"


@query(
    "pulse_extremes",
    _PULSE_CTES
    + f""", ranked AS (
    SELECT region, delivery_ts, price_cents,
           row_number() OVER (PARTITION BY region ORDER BY price_cents, delivery_ts) AS lo,
           row_number() OVER (PARTITION BY region ORDER BY price_cents DESC, delivery_ts) AS hi
    FROM w14)
SELECT a.region, a.delivery_ts AS cheapest_ts, strftime({S.local('a.delivery_ts')}, {_LOCAL_FMT}) AS cheapest_local,
       {S.price('a.price_cents')} AS cheapest_price,
       b.delivery_ts AS priciest_ts, strftime({S.local('b.delivery_ts')}, {_LOCAL_FMT}) AS priciest_local,
       {S.price('b.price_cents')} AS priciest_price
FROM ranked a JOIN ranked b ON a.region = b.region AND a.lo = 1 AND b.hi = 1""",
)
def pulse_extremes(spark, sf_dir):
    """Cheapest and priciest hour of the last 14 days, local time text."""
    return pulse.extremes(_points(spark, sf_dir), state.as_of())


def _split_sql(daytype: str, cond: str) -> str:
    return f"""SELECT region, '{daytype}' AS daytype,
       {S.avg2(f'sum(price_cents) FILTER (WHERE {cond})', f'count(*) FILTER (WHERE {cond})')} AS avg_price,
       count(*) FILTER (WHERE {cond}) AS hours
FROM w14 GROUP BY region"""


_WEEKEND = f"dayofweek({S.local('delivery_ts')}) IN (0, 6)"


@query(
    "pulse_split",
    _PULSE_CTES + _split_sql("weekday", f"NOT {_WEEKEND}") + "\nUNION ALL\n" + _split_sql("weekend", _WEEKEND),
)
def pulse_split(spark, sf_dir):
    """Weekday and weekend mean and hours over the last 14 days."""
    return pulse.split(_points(spark, sf_dir), state.as_of())


def _local_text_sql(ts: str) -> str:
    offset = f"CAST((epoch({S.local(ts)}) - epoch({ts})) / 3600 AS INTEGER)"
    zone = f"CASE {offset} WHEN 1 THEN 'CET' WHEN 2 THEN 'CEST' END"
    return f"(strftime({S.local(ts)}, '%Y-%m-%d %H:%M') || ' ' || {zone})"


_DUE_SQL = S.to_utc(
    f"""CAST(CASE WHEN hour({S.local(S.AS_OF_SQL)}) >= 5 THEN CAST({S.local(S.AS_OF_SQL)} AS DATE)
        ELSE CAST({S.local(S.AS_OF_SQL)} AS DATE) - 1 END AS TIMESTAMP) + INTERVAL 23 HOUR"""
)


@query(
    "freshness",
    S.with_(*S.SERVING_CTES)
    + f""", f AS (SELECT max(delivery_ts) AS latest, {_DUE_SQL} AS due,
                 (epoch(max(delivery_ts)) - epoch({S.AS_OF_SQL})) / 3600.0 AS hours FROM serving),
g AS (SELECT *, 'newest hour ' || {_local_text_sql('latest')} || ' (' ||
         CASE WHEN hours >= 0 THEN printf('%.1f h ahead', hours) ELSE printf('%.1f h old', -hours) END || ')' AS head
      FROM f)
SELECT '{health.CHECK_NAME}' AS check_name,
       CASE WHEN latest IS NULL THEN 'fail' WHEN latest >= due THEN 'ok' ELSE 'fail' END AS status,
       CASE WHEN latest IS NULL THEN '{health.EMPTY_DETAIL}'
            WHEN latest >= due THEN head || '; due through ' || {_local_text_sql('due')}
            ELSE head || '; hours through ' || {_local_text_sql('due')} || ' {health.MISSING_SUFFIX}' END AS detail,
       {S.AS_OF_SQL} AS checked_at
FROM g""",
)
def freshness(spark, sf_dir):
    """M2/K4: serving freshness row for ``pipeline_health``."""
    return health.freshness(state.serving(spark, sf_dir), state.as_of())


@query(
    "freshness_gaps",
    S.with_(*S.SERVING_CTES)
    + f""", steps AS (SELECT region, delivery_ts,
         coalesce(lead(delivery_ts) OVER (PARTITION BY region ORDER BY delivery_ts),
                  greatest({_DUE_SQL} + INTERVAL 1 HOUR, delivery_ts + INTERVAL 1 HOUR)) AS following
       FROM serving WHERE delivery_ts <= {_DUE_SQL})
SELECT region, delivery_ts + INTERVAL 1 HOUR AS first_missing, following - INTERVAL 1 HOUR AS last_missing,
       CAST((epoch(following) - epoch(delivery_ts)) / 3600 - 1 AS BIGINT) AS hours
FROM steps WHERE following > delivery_ts + INTERVAL 1 HOUR""",
)
def freshness_gaps(spark, sf_dir):
    """Runs of missing hours per region through the due hour, which the freshness row
    does not see."""
    return health.gaps(state.serving(spark, sf_dir), state.as_of())
