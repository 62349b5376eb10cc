"""Oracle SQL building blocks (DuckDB dialect, plain ANSI where possible).

The oracle derives every input from the driver tables on its own: it never
sees a Spark plan. Shared pieces are common table expressions that mirror the
fixture mapping of FIXTURES.md; the rounding expressions are the integer-cent
recipe used on the Spark side.
"""

from __future__ import annotations

from gridlake.sources.fixtures import AS_OF, PREVIOUS_RUN, PRICE_OFFSET_CENTS

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"
PREVIOUS_SQL = f"TIMESTAMP '{PREVIOUS_RUN}'"


def local(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin'"


def to_utc(local_ts: str) -> str:
    return f"(({local_ts}) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC'"


def round_ratio(num: str, den: str, scale: int) -> str:
    """Half away from zero, as double; NULL when den = 0."""
    return (
        f"(CASE WHEN ({den}) > 0 THEN CAST(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))) AS DOUBLE)"
        f" / {10 ** scale} END)"
    )


def avg2(sum_cents: str = "sum(price_cents)", n: str = "count(price_cents)") -> str:
    return round_ratio(sum_cents, n, 2)


def avg_exact(sum_cents: str = "sum(price_cents)", n: str = "count(price_cents)") -> str:
    return f"(CASE WHEN ({n}) > 0 THEN CAST({sum_cents} AS DOUBLE) / (CAST({n} AS DOUBLE) * 100.0) END)"


def pct1(part: str, total: str) -> str:
    return round_ratio(f"CAST({part} AS BIGINT) * 1000", total, 1)


def price(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) / 100.0)"


def obs(where: str = "") -> str:
    cond = f"WHERE {where}" if where else ""
    return f"""
    SELECT event_id, event_type AS region, date_trunc('hour', ts) AS delivery_ts,
           CAST(round(value * 100) AS BIGINT) - {PRICE_OFFSET_CENTS} AS price_cents,
           CAST(CAST(round(value * 100) AS BIGINT) - {PRICE_OFFSET_CENTS} AS DOUBLE) / 100.0 AS price_eur_mwh,
           'events' AS source, ts AS fetched_at
    FROM events {cond}"""


def latest(src: str = "obs") -> str:
    return f"""
    SELECT * FROM {src}
    QUALIFY row_number() OVER (PARTITION BY region, delivery_ts ORDER BY fetched_at DESC) = 1"""


def silver(src: str = "latest", updated_at: str = AS_OF_SQL) -> str:
    return f"""
    SELECT region, delivery_ts, price_eur_mwh, price_cents, local_ts,
           CAST(hour(local_ts) AS INTEGER) AS local_hour,
           dayofweek(local_ts) IN (0, 6) AS is_weekend,
           price_eur_mwh < 0 AS is_negative,
           source, {updated_at} AS updated_at
    FROM (SELECT *, {local('delivery_ts')} AS local_ts FROM {src}) s"""


def gold(src: str = "silver", updated_at: str = AS_OF_SQL) -> str:
    return f"""
    SELECT region, CAST(local_ts AS DATE) AS local_day,
           {avg2()} AS avg_price,
           {price('min(price_cents)')} AS min_price,
           {price('max(price_cents)')} AS max_price,
           CAST(count(*) FILTER (WHERE is_negative) AS INTEGER) AS negative_hours,
           {updated_at} AS updated_at
    FROM {src} GROUP BY 1, 2"""


def serving_hourly(src: str = "silver") -> str:
    return f"""
    SELECT region, delivery_ts, CAST(coalesce(price_eur_mwh, 0.0) AS DECIMAL(10,2)) AS price_eur_mwh,
           local_hour, coalesce(is_weekend, false) AS is_weekend,
           coalesce(is_negative, false) AS is_negative, updated_at,
           CAST(round(coalesce(price_eur_mwh, 0.0) * 100) AS BIGINT) AS price_cents
    FROM {src}"""


def serving_daily(src: str = "gold") -> str:
    return f"""
    SELECT region, local_day,
           CAST(coalesce(avg_price, 0.0) AS DECIMAL(10,2)) AS avg_price,
           CAST(coalesce(min_price, 0.0) AS DECIMAL(10,2)) AS min_price,
           CAST(coalesce(max_price, 0.0) AS DECIMAL(10,2)) AS max_price,
           coalesce(negative_hours, 0) AS negative_hours, updated_at
    FROM {src}"""


def window_start(since_hours: int = 168, aligned: bool = True) -> str:
    start = f"({AS_OF_SQL} - INTERVAL {since_hours} HOUR)"
    if not aligned:
        return start
    return to_utc(f"date_trunc('day', {local(start)})")


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes) + "\n"


# The pipeline state every analytical query reads: serving tables after a
# full-history recompute.
SERVING_CTES = (
    ("obs", obs()),
    ("latest", latest()),
    ("silver", silver()),
    ("serving", serving_hourly()),
)
DAILY_CTES = SERVING_CTES[:3] + (("gold", gold()), ("daily", serving_daily()))
