"""Semantic rules of SURVEY §1.3 that need their own fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from gridlake import lake as L
from gridlake.functions.time import ts_literal
from gridlake.jobs import transform
from gridlake.operators.medallion import enrich, serving_daily, serving_hourly
from gridlake.schemas import BRONZE, GOLD_DAILY
from gridlake.sinks import tables as TB

AS_OF = "2026-01-20 00:00:00"


def test_negative_flag_uses_the_unrounded_price(spark):
    bronze = spark.createDataFrame(
        [("DE-LU", dt.datetime(2026, 1, 6, 0), -0.004, "a", dt.datetime(2026, 1, 6)),
         ("DE-LU", dt.datetime(2026, 1, 6, 1), None, "a", dt.datetime(2026, 1, 6))],
        BRONZE,
    )
    rows = {r.delivery_ts.hour: r for r in serving_hourly(enrich(bronze, ts_literal(AS_OF))).collect()}
    assert (rows[0].price_eur_mwh, rows[0].is_negative) == (Decimal("0.00"), True)
    # A NULL price is served as 0 with false flags.
    assert (rows[1].price_eur_mwh, rows[1].is_negative) == (Decimal("0.00"), False)


def test_serving_daily_coerces_nulls(spark):
    gold = spark.createDataFrame([("DE-LU", dt.date(2026, 1, 6), None, None, None, None, dt.datetime(2026, 1, 7))], GOLD_DAILY)
    row = serving_daily(gold).first()
    assert (row.avg_price, row.min_price, row.max_price, row.negative_hours) == (Decimal("0.00"),) * 3 + (0,)


def _negative_hours_by_day(spark, lake):
    return {str(r.local_day): r.negative_hours for r in spark.read.parquet(lake.path(L.GOLD_DAILY)).collect()}


def test_aligned_window_keeps_whole_days_unaligned_shrinks_them(spark, scratch):
    # Ten days of hours, every price negative: negative_hours = hours counted.
    start = dt.datetime(2026, 1, 9, 23, 0)  # 2026-01-10 00:00 in Berlin (CET)
    rows = [("DE-LU", start + dt.timedelta(hours=h), -1.0, "a", start) for h in range(24 * 11)]
    bronze = L.with_delivery_date(spark.createDataFrame(rows, BRONZE))
    results = {}
    for aligned in (True, False):
        lake = L.Lake(f"{scratch}/{aligned}")
        TB.merge_into(spark, lake.path(L.BRONZE), BRONZE, bronze, L.BRONZE.keys, L.BRONZE.partition_cols, "load")
        # Two hourly runs, thirteen hours apart, with the default 168 h window.
        transform.run_transform(spark, lake, "2026-01-20 00:00:00", align_days=aligned, run_id="r1")
        transform.run_transform(spark, lake, "2026-01-20 13:00:00", align_days=aligned, run_id="r2")
        results[aligned] = _negative_hours_by_day(spark, lake)
    # The oldest day still in the window: 2026-01-13 local.
    assert results[True]["2026-01-13"] == 24
    assert results[False]["2026-01-13"] < 24
