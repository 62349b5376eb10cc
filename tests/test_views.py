"""SQL statements over the stored serving tables."""

from __future__ import annotations

import re

import pytest

from gridlake import lake as L
from gridlake.plans import bi, views
from gridlake.sources import fixtures as X
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    found = views.served(spark, SF_SMALL)
    views.register(spark, found)
    return found


def test_statements_read_the_stored_tables_only(spark, lake):
    for name in views.STATEMENTS:
        found = views.run(spark, name, X.DASHBOARD_REGION, X.AS_OF)
        files, plan = found.inputFiles(), _plan(found)
        assert files and all("/serving_price_hourly/" in f or "/serving_daily_stats/" in f for f in files), name
        assert "Window" not in plan and "from_json" not in plan, name


def test_time_range_prunes_day_partitions(spark, lake):
    plan = _plan(views.run(spark, "dash_price_series", X.DASHBOARD_REGION, X.AS_OF))
    assert re.search(r"PartitionFilters: \[[^\n]*delivery_date[^\n]*>=", plan), plan


def test_served_once_an_application(spark, lake):
    assert views.served(spark, SF_SMALL) == lake


def test_one_region_equals_the_frame_api(spark, lake):
    hours = spark.read.parquet(lake.path(L.SERVING_HOURLY))
    for region in ("purchase", "nowhere", "x' OR '1' = '1"):
        want = bi.negative_totals(bi.for_region(hours, region)).first().asDict()
        assert views.run(spark, "bi_negative_totals", region).first().asDict() == want


def test_panels_need_a_time_and_names_must_be_known(spark, lake):
    with pytest.raises(ValueError):
        views.run(spark, "dash_range_stats", X.DASHBOARD_REGION)
    with pytest.raises(KeyError):
        views.run(spark, "drop_everything")


def test_views_of_an_empty_lake(spark, scratch, lake):
    views.register(spark, L.Lake(f"{scratch}/none"))
    try:
        row = views.run(spark, "bi_negative_totals").first()
        assert (row.total_hours, row.avg_price, row.pct_negative) == (0, None, None)
        assert views.run(spark, "bi_worst_days").count() == 0
    finally:
        views.register(spark, lake)
