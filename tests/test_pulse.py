"""Market pulse: windows, future hours, raw-price ties, empty input."""

from __future__ import annotations

import datetime as dt

from gridlake.functions.time import ts_literal
from gridlake.operators import pulse

NOW = dt.datetime(2025, 2, 3, 6, 0)  # a Monday, 07:00 in Berlin


def points(spark, data, region="N"):
    rows = [(region, NOW - dt.timedelta(hours=h), float(p)) for h, p in data]
    return spark.createDataFrame(rows, "region string, delivery_ts timestamp, price_eur_mwh double")


def test_windows_count_back_from_the_newest_hour(spark):
    pts = points(spark, [(2, 4.0), (25, -1.5), (26, 8.0), (24 * 7 + 1, 100.0), (24 * 20, -500.0)])
    got = {
        r.window_days: (r.hours, r.avg_price, r.min_price, r.max_price, r.negative_hours, r.negative_share)
        for r in pulse.windows(pts, ts_literal(NOW)).collect()
    }
    assert got == {1: (2, 1.25, -1.5, 4.0, 1, 50.0), 7: (4, 27.63, -1.5, 100.0, 1, 25.0), 14: (4, 27.63, -1.5, 100.0, 1, 25.0)}


def test_extremes_and_split(spark):
    pts = points(spark, [(1, 40.0), (7, 12.0), (8, 90.0), (30, 55.5)])
    e = pulse.extremes(pts, ts_literal(NOW)).first()
    assert (e.cheapest_local, e.cheapest_price) == ("Mon 03 Feb 00:00", 12.0)
    assert (e.priciest_local, e.priciest_price) == ("Sun 02 Feb 23:00", 90.0)
    split = {r.daytype: (r.avg_price, r.hours) for r in pulse.split(pts, ts_literal(NOW)).collect()}
    assert split == {"weekday": (26.0, 2), "weekend": (72.75, 2)}


def test_prices_are_averaged_raw_and_compared_raw(spark):
    pts = points(spark, [(3, 0.006), (2, 0.006), (1, 0.0), (0, 0.004)])
    day = {r.window_days: r for r in pulse.windows(pts, ts_literal(NOW)).collect()}[1]
    assert day.avg_price == 0.0 and day.max_price == 0.01
    e = pulse.extremes(pts, ts_literal(NOW)).first()
    assert e.cheapest_ts == NOW - dt.timedelta(hours=1)  # not the hour whose cents are equal
    assert e.priciest_ts == NOW - dt.timedelta(hours=3)  # a tie goes to the earlier hour


def test_unpublished_hours_and_empty_input(spark):
    later = pulse.windows(points(spark, [(5, 3.0), (-1, 700.0)]), ts_literal(NOW)).collect()
    assert {r.max_price for r in later} == {3.0}
    none = points(spark, [])
    assert pulse.windows(none, ts_literal(NOW)).count() == pulse.extremes(none, ts_literal(NOW)).count() == 0
