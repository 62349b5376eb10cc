"""Landed API files: week chunks, latest weeks, sample file and replay."""

from __future__ import annotations

from gridlake.operators.revisions import latest_revision
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import KEYS
from gridlake.sources import landed as L

LATEST_WEEKS = 2
# Rows that no reader may take for a point: (JSON, as text array, reason).
_BAD_ROWS = (
    ('["bad","row"]', '["bad","row"]', L.BAD_TIME),
    ("[1]", '["1"]', L.NOT_A_PAIR),
    ('[0,"NaN"]', '["0","NaN"]', L.BAD_PRICE),
    ('[0,"Infinity"]', '["0","Infinity"]', L.BAD_PRICE),
    ("[0,123456789012]", '["0","123456789012"]', L.BAD_PRICE),
)
_APPENDED = ",".join(j for j, *_ in _BAD_ROWS)


def _points(spark, sf_dir, through=None):
    return latest_revision(state.bronze(spark, sf_dir, through=through), KEYS).select("region", "delivery_ts", "price_eur_mwh")


def _chunks(spark, sf_dir):
    return L.week_chunk_documents(_points(spark, sf_dir), _APPENDED)


_WEEK = S.to_utc(f"date_trunc('week', {S.local('delivery_ts')})")
_CHUNK_CTES = S.with_(
    ("obs", S.obs()),
    ("latest", S.latest()),
    ("pts", f"SELECT region, delivery_ts, price_eur_mwh, epoch_ms(delivery_ts) AS ms, epoch_ms({_WEEK}) AS week_start_ms FROM latest"),
)


@query(
    "week_chunks",
    _CHUNK_CTES
    + f"""SELECT region, week_start_ms,
       '{{"meta_data":' || json_object('region', region, 'resolution', 'hour')::VARCHAR || ',"series":[' ||
       string_agg('[' || CAST(ms AS VARCHAR) || ',' || CAST(price_eur_mwh AS VARCHAR) || ']', ',' ORDER BY ms)
       || ',[' || CAST(max(ms) + {L.HOUR_MS} AS VARCHAR) || ',null],{_APPENDED}]}}' AS text
FROM pts GROUP BY region, week_start_ms""",
)
def week_chunks(spark, sf_dir):
    """K-side of S4: one API-shaped JSON document per (region, local week)."""
    return _chunks(spark, sf_dir)


@query(
    "week_chunk_points",
    _CHUNK_CTES + "SELECT region, delivery_ts, price_eur_mwh FROM pts",
)
def week_chunk_points(spark, sf_dir):
    """Chunk documents parsed back to points; unpublished and
    malformed rows skipped."""
    return L.parse_week_chunks(_chunks(spark, sf_dir))


@query(
    "chunk_rejects",
    _CHUNK_CTES
    + "SELECT region, b.row, b.reason FROM (SELECT DISTINCT region, week_start_ms FROM pts) w, (VALUES "
    + ", ".join(f"('{t}', '{r}')" for _, t, r in _BAD_ROWS)
    + ") b(row, reason)",
)
def chunk_rejects(spark, sf_dir):
    """Chunk rows that are no points, with the reason."""
    return L.chunk_rejects(_chunks(spark, sf_dir))


@query(
    "latest_weeks",
    _CHUNK_CTES
    + f""", idx AS (SELECT DISTINCT region, week_start_ms FROM pts),
newest AS (SELECT region, week_start_ms FROM idx
           QUALIFY row_number() OVER (PARTITION BY region ORDER BY week_start_ms DESC) <= {LATEST_WEEKS})
SELECT region, delivery_ts, price_eur_mwh FROM pts JOIN newest USING (region, week_start_ms)""",
)
def latest_weeks(spark, sf_dir):
    """Points of the newest two week chunks of each region."""
    return L.parse_week_chunks(L.latest_chunks(_chunks(spark, sf_dir), LATEST_WEEKS))


_SAMPLE_CTES = S.with_(
    ("obs", S.obs()),
    ("latest", S.latest()),
    (
        "last",
        f"""SELECT region, delivery_ts, price_eur_mwh, epoch_ms(delivery_ts) AS ms FROM latest
        WHERE delivery_ts <= {S.AS_OF_SQL}
        QUALIFY row_number() OVER (PARTITION BY region ORDER BY delivery_ts DESC) <= {L.SAMPLE_HOURS}""",
    ),
)


@query(
    "sample_document",
    _SAMPLE_CTES
    + f"""SELECT region, count(*) AS hours,
       '{{"meta":' || json_object('source', 'events', 'region', region, 'resolution', 'hour',
                                  'generated_at', strftime({S.AS_OF_SQL}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
                                  'hours', count(*))::VARCHAR ||
       ',"series":[' || string_agg('[' || CAST(ms AS VARCHAR) || ',' || CAST(price_eur_mwh AS VARCHAR) || ']', ',' ORDER BY ms)
       || ']}}' AS text
FROM last GROUP BY region""",
)
def sample_document(spark, sf_dir):
    """K6: the last 168 published hours of each region as a sample file."""
    return L.sample_documents(_points(spark, sf_dir, state.as_of()), state.as_of())


@query(
    "replay_order",
    _CHUNK_CTES
    + f"""SELECT region, delivery_ts, price_eur_mwh,
       region || '|' || strftime(delivery_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS key,
       json_object('region', region, 'delivery_ts', strftime(delivery_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00',
                   'price_eur_mwh', price_eur_mwh, 'source', 'events',
                   'fetched_at', strftime({S.AS_OF_SQL}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')::VARCHAR AS value
FROM pts""",
)
def replay_order(spark, sf_dir):
    """K5: all landed points replayed in (time, region) order as keyed messages."""
    return L.replay_lines(L.parse_week_chunks(_chunks(spark, sf_dir)), state.as_of())


@query(
    "sample_points",
    _SAMPLE_CTES + "SELECT region, delivery_ts, price_eur_mwh FROM last",
)
def sample_points(spark, sf_dir):
    """Sample documents read strictly."""
    return L.parse_sample(L.sample_documents(_points(spark, sf_dir, state.as_of()), state.as_of()))
