"""Medallion queries: silver, windows, gold, MERGE equivalents, serving."""

from __future__ import annotations

from gridlake.functions.time import window_start
from gridlake.operators import daily_state as DS
from gridlake.operators import medallion as M
from gridlake.operators.revisions import upsert
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import KEYS
from gridlake.sources import fixtures as X

WINDOW_HOURS = 168

_SILVER_OUT = "region, delivery_ts, price_eur_mwh, local_ts, local_hour, is_weekend, is_negative, source, updated_at"
_GOLD_OUT = "region, local_day, avg_price, min_price, max_price, negative_hours, updated_at"


def _silver_window(spark, sf_dir, align_days=True):
    as_of = state.as_of()
    since = window_start(as_of, WINDOW_HOURS, align_days)
    return M.silver(state.bronze(spark, sf_dir, since=since), as_of, WINDOW_HOURS, align_days)


def _silver_previous(spark, sf_dir):
    """Silver as the earlier run stored it: the whole history that it had seen."""
    return M.silver(X.observations(spark, sf_dir, fetched_through=state.previous_run()), state.previous_run())


@query(
    "gold_daily",
    S.with_(*S.SERVING_CTES[:3]) + f"SELECT {_GOLD_OUT} FROM ({S.gold()}) g",
)
def gold_daily(spark, sf_dir):
    """Daily aggregates per region and local day (the flagship slice)."""
    return state.gold(spark, sf_dir)


@query("gold_incremental", S.with_(*S.SERVING_CTES[:3]) + f"SELECT {_GOLD_OUT} FROM ({S.gold()}) g")
def gold_incremental(spark, sf_dir):
    """A1 without regrouping: states of the days as the odd events left them take the even
    events' revisions in."""
    before = M.silver(X.observations(spark, sf_dir, batch=1), state.previous_run())
    now = state.silver(spark, sf_dir)
    revised = now.join(X.observations(spark, sf_dir, batch=0).select(*KEYS).distinct(), list(KEYS), "left_semi")
    after = DS.absorb(DS.states(before), DS.signed_rows(before, revised), now)
    return DS.gold(after, state.as_of())


def _gold_mills(src: str) -> str:
    """Gold rows from prices in tenths of a cent (column mills)."""
    low, high = S.round_ratio("min(mills)", "10", 2), S.round_ratio("max(mills)", "10", 2)
    return f"""SELECT region, CAST(local_ts AS DATE) AS local_day, {S.round_ratio('sum(mills)', 'count(*) * 10', 2)} AS avg_price,
       {low} AS min_price, {high} AS max_price, CAST(count(*) FILTER (WHERE mills < 0) AS INTEGER) AS negative_hours,
       {S.AS_OF_SQL} AS updated_at
FROM (SELECT *, {S.local('delivery_ts')} AS local_ts FROM {src}) s GROUP BY 1, 2"""


@query(
    "gold_subcent",
    S.with_(
        ("obs", f"""SELECT event_type AS region, date_trunc('hour', ts) AS delivery_ts, ts AS fetched_at,
                 CAST(round(value * 100) AS BIGINT) - {X.PRICE_OFFSET_CENTS} AS mills FROM events"""),
        ("latest", S.latest()),
    )
    + _gold_mills("latest"),
)
def gold_subcent(spark, sf_dir):
    """Gold of prices with a tenth of a cent: averages are taken on the raw prices and
    rounded once."""
    bronze = X.observations(spark, sf_dir, price_scale=1000)
    return M.gold_daily(M.silver(bronze, state.as_of()), state.as_of())


@query("silver_enriched", S.with_(*S.SERVING_CTES[:3]) + f"SELECT {_SILVER_OUT} FROM silver")
def silver_enriched(spark, sf_dir):
    return state.silver(spark, sf_dir)


_WINDOW_SQL = S.with_(
    ("obs", S.obs()),
    ("win", f"SELECT * FROM obs WHERE delivery_ts >= {S.window_start(WINDOW_HOURS)}"),
    ("latest", S.latest("win")),
    ("silver", S.silver()),
)


@query("window_recompute", _WINDOW_SQL + f"SELECT {_SILVER_OUT} FROM silver")
def window_recompute(spark, sf_dir):
    """Silver rows of the trailing 168 h, window start floored to local midnight."""
    return _silver_window(spark, sf_dir)


@query(
    "window_recompute_unaligned",
    S.with_(
        ("obs", S.obs()),
        ("win", f"SELECT * FROM obs WHERE delivery_ts >= {S.window_start(WINDOW_HOURS, aligned=False)}"),
        ("latest", S.latest("win")),
        ("silver", S.silver()),
    )
    + f"SELECT {_SILVER_OUT} FROM silver",
)
def window_recompute_unaligned(spark, sf_dir):
    """The reference's plain ``as_of - 168 h`` window start."""
    return _silver_window(spark, sf_dir, align_days=False)


_PREV_CTES = (
    ("obs1", S.obs(f"ts <= {S.PREVIOUS_SQL}")),
    ("latest1", S.latest("obs1")),
    ("target", S.silver("latest1", S.PREVIOUS_SQL)),
)


@query(
    "silver_merge",
    _WINDOW_SQL.rstrip("\n")
    + ",\n"
    + ",\n".join(f"{n} AS ({b})" for n, b in _PREV_CTES)
    + f"""
SELECT {_SILVER_OUT} FROM target t
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.region = t.region AND s.delivery_ts = t.delivery_ts)
UNION ALL SELECT {_SILVER_OUT} FROM silver""",
)
def silver_merge(spark, sf_dir):
    """Stored silver (earlier run) upserted with the window recompute."""
    return upsert(_silver_previous(spark, sf_dir), _silver_window(spark, sf_dir), KEYS)


@query(
    "gold_merge",
    _WINDOW_SQL.rstrip("\n")
    + ",\n"
    + ",\n".join(f"{n} AS ({b})" for n, b in _PREV_CTES)
    + f""",
incoming AS ({S.gold('silver')}),
stored AS ({S.gold('target', S.PREVIOUS_SQL)})
SELECT {_GOLD_OUT} FROM stored t
WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.region = t.region AND s.local_day = t.local_day)
UNION ALL SELECT {_GOLD_OUT} FROM incoming""",
)
def gold_merge(spark, sf_dir):
    """Stored gold upserted with gold regrouped from the window's silver rows."""
    incoming = M.gold_daily(_silver_window(spark, sf_dir), state.as_of())
    stored = M.gold_daily(_silver_previous(spark, sf_dir), state.previous_run())
    return upsert(stored, incoming, ["region", "local_day"])


_SERVING_OUT = "region, delivery_ts, price_eur_mwh, local_hour, is_weekend, is_negative, updated_at"


@query(
    "serving_hourly",
    _WINDOW_SQL.rstrip("\n")
    + ",\n"
    + ",\n".join(f"{n} AS ({b})" for n, b in _PREV_CTES)
    + f""",
incoming AS ({S.serving_hourly('silver')}),
stored AS ({S.serving_hourly('target')})
SELECT {_SERVING_OUT} FROM stored t
WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.region = t.region AND s.delivery_ts = t.delivery_ts)
UNION ALL SELECT {_SERVING_OUT} FROM incoming""",
)
def serving_hourly(spark, sf_dir):
    """Hourly serving upsert: stored rows replaced by the window's silver rows."""
    incoming = M.serving_hourly(_silver_window(spark, sf_dir))
    stored = M.serving_hourly(_silver_previous(spark, sf_dir))
    return upsert(stored, incoming, KEYS)


@query(
    "serving_daily",
    _WINDOW_SQL.rstrip("\n")
    + ",\n"
    + ",\n".join(f"{n} AS ({b})" for n, b in _PREV_CTES)
    + f""",
incoming AS ({S.serving_daily(f"({S.gold('silver')}) g WHERE updated_at >= {S.window_start(WINDOW_HOURS)}")}),
stored AS ({S.serving_daily(f"({S.gold('target', S.PREVIOUS_SQL)}) g")})
SELECT {_GOLD_OUT} FROM stored t
WHERE NOT EXISTS (SELECT 1 FROM incoming s WHERE s.region = t.region AND s.local_day = t.local_day)
UNION ALL SELECT {_GOLD_OUT} FROM incoming""",
)
def serving_daily(spark, sf_dir):
    """Daily serving upsert with gold rows refreshed since the window start."""
    as_of = state.as_of()
    gold_rows = M.gold_daily(_silver_window(spark, sf_dir), as_of)
    incoming = M.serving_daily(gold_rows, refreshed_since=window_start(as_of, WINDOW_HOURS))
    stored = M.serving_daily(M.gold_daily(_silver_previous(spark, sf_dir), state.previous_run()))
    return upsert(stored, incoming, ["region", "local_day"])


@query(
    "serving_state",
    S.with_(*S.SERVING_CTES) + f"SELECT {_SERVING_OUT} FROM serving",
)
def serving_state(spark, sf_dir):
    """The hourly serving table after a full-history recompute (BI input)."""
    return state.serving(spark, sf_dir)


@query(
    "serving_daily_state",
    S.with_(*S.DAILY_CTES) + f"SELECT {_GOLD_OUT} FROM daily",
)
def serving_daily_state(spark, sf_dir):
    return state.daily(spark, sf_dir)



@query(
    "lake_gold",
    S.with_(*S.SERVING_CTES[:3]) + f"SELECT {_GOLD_OUT} FROM ({S.gold()}) g",
)
def lake_gold(spark, sf_dir):
    """The write path end to end: bronze loaded in two batches through the
    revision-aware table merge, the transform job over the whole history,
    gold read back from its table (a fresh lake under the session's
    checkpoint folder)."""
    import uuid

    from gridlake import lake as L
    from gridlake.jobs.transform import run_transform
    from gridlake.schemas import BRONZE
    from gridlake.session import ensure_checkpoint_dir
    from gridlake.sinks import tables as TB

    lake = L.Lake(f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridlake-lake-{uuid.uuid4().hex}")
    for batch in (1, 0):
        rows = L.with_delivery_date(X.observations(spark, sf_dir, batch=batch))
        TB.merge_into(spark, lake.path(L.BRONZE), BRONZE, rows, L.BRONZE.keys, L.BRONZE.partition_cols, f"load-{batch}")
    run_transform(spark, lake, X.AS_OF, since_hours=None, run_id="full")
    return spark.read.parquet(lake.path(L.GOLD_DAILY)).select(*[c.strip() for c in _GOLD_OUT.split(",")])
