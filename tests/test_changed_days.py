"""Days touched by merges are recomputed, however old; nothing else is read."""

from __future__ import annotations

import datetime as dt

from gridlake import lake as L
from gridlake.jobs import ingest, transform
from gridlake.schemas import BRONZE

AS_OF = "2026-02-01 00:00:00"


def _rows(spark, points):
    return L.with_delivery_date(spark.createDataFrame([("R", t, p, "s", f) for t, p, f in points], BRONZE))


def _daily(spark, lake):
    return {r.local_day.isoformat(): (float(r.avg_price), float(r.max_price)) for r in spark.read.parquet(lake.path(L.SERVING_DAILY)).collect()}


def test_late_revisions_are_served_and_only_their_days_are_read(spark, scratch, monkeypatch):
    lake = L.Lake(scratch)
    day = lambda d, h=0: dt.datetime(2026, 1, d, h)
    hours = [(day(d, h), 10.0, day(d, h)) for d in (2, 3, 20, 30) for h in range(6)]
    ingest.merge_bronze(spark, lake, _rows(spark, hours), "b1")
    assert transform.run_changed_days(spark, lake, AS_OF) == {"days": 4}
    assert transform.run_changed_days(spark, lake, AS_OF) == {"days": 0}
    # A revision older than the window, and older than the newest one of its day.
    late = [(day(2, 3), 40.0, day(2, 4))]
    ingest.merge_bronze(spark, lake, _rows(spark, late), "b2")
    transform.run_transform(spark, lake, AS_OF)
    assert _daily(spark, lake)["2026-01-02"] == (10.0, 10.0)
    read = []
    where = transform.TB.read_table

    def told(spark, path, like):
        read.append(path.rsplit("/", 1)[-1])
        return where(spark, path, like)

    monkeypatch.setattr(transform.TB, "read_table", told)
    written = {}
    merge = transform.TB.merge_into

    def kept(spark, path, schema, batch, keys, cols, batch_id, **more):
        written[path.rsplit("/", 1)[-1]] = sorted({str(r[0]) for r in batch.select(*cols).distinct().collect()})
        plan = batch._jdf.queryExecution().executedPlan().toString()
        if "silver" in batch_id:
            assert "PartitionFilters: [delivery_date" in plan or "2026-01-02" in plan
        return merge(spark, path, schema, batch, keys, cols, batch_id, **more)

    monkeypatch.setattr(transform.TB, "merge_into", kept)
    assert transform.run_changed_days(spark, lake, AS_OF) == {"days": 1}
    assert _daily(spark, lake)["2026-01-02"] == (15.0, 40.0) and _daily(spark, lake)["2026-01-20"] == (10.0, 10.0)
    assert written["silver_prices"] == written["serving_price_hourly"] == ["2026-01-02"]
    assert set(written["gold_daily"]) <= {"2026-01-02", "2026-01-03"}


def test_a_crash_leaves_the_days_open(spark, scratch, monkeypatch):
    lake = L.Lake(scratch)
    rows = [(dt.datetime(2026, 1, 5, h), 1.0 + h, dt.datetime(2026, 1, 5, h)) for h in range(3)]
    ingest.merge_bronze(spark, lake, _rows(spark, rows), "b1")

    def crash(*args, **more):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(transform.M, "serving_daily", crash)
        try:
            transform.run_changed_days(spark, lake, AS_OF)
        except RuntimeError:
            pass
    assert transform.run_changed_days(spark, lake, AS_OF) == {"days": 1}
    assert _daily(spark, lake)["2026-01-05"] == (2.0, 3.0)
