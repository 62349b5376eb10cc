"""Plan checks over every registered query: column pruning reaches the scans."""

from __future__ import annotations

import re

import pytest

from gridlake.plans.registry import all_queries
from tests.conftest import SF_SMALL

# Columns no query needs: a scan that reads them is not pruned.
UNUSED = {"events": {"user_id", "props"}, "documents": {"lang", "n_chars"}}
# Queries that run a job when called (their plans read the lake, not the inputs).
JOBS = {
    "stream_bronze", "stream_changed_prices", "stream_rejects", "lake_gold", "lake_news", "lake_serving_hourly",
    "lake_serving_daily", "lake_health", "lake_compacted", "headline_lines", "lake_late_revision",
}
# Queries over a stretch of time: a bound on the raw event time reaches the scan.
BOUNDED = (
    "window_recompute", "window_recompute_unaligned", "sample_document", "dash_range_stats", "dash_price_series",
    "dash_hour_profile", "pulse_windows", "pulse_extremes", "pulse_split",
)


@pytest.mark.parametrize("name", BOUNDED)
def test_time_filters_reach_the_scan(spark, name):
    plan = all_queries()[name].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[([^\n]*)", plan)  # the plan text may cut the list short
    assert pushed and all(re.search(r"(GreaterThanOrEqual|LessThan)\(ts,", p) for p in pushed), pushed


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if n not in JOBS and not n.startswith("view_")))
def test_scans_read_only_needed_columns(spark, name):
    df = all_queries()[name].fn(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*Location: [^\n]*?/(\w+)\.parquet", plan)
    assert scans, name
    for scan in scans:
        columns = {c.split("#")[0] for c in scan[0].split(",")}
        assert not (columns & UNUSED.get(scan[1], set())), (name, scan[1], columns)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merges_and_dedupes_limit_before_the_shuffle(spark):
    import datetime as dt

    from gridlake.operators.revisions import revision_merge
    from gridlake.schemas import BRONZE, KEYS
    from gridlake.sources import feeds as FD

    rows = spark.createDataFrame([("A", dt.datetime(2026, 1, 1), 1.0, "s", dt.datetime(2026, 1, 1))], BRONZE)
    merge_plan = _plan(revision_merge(rows, rows, KEYS))
    feeds = spark.createDataFrame([("https://e/feed", "<rss><channel></channel></rss>")], "url string, xml string")
    feed_plan = _plan(FD.parse_feeds(feeds))
    for plan in (merge_plan, feed_plan):
        partial = plan.find("row_number(), 1, Partial")
        exchange = plan.rfind("Exchange hashpartitioning")
        # The partial limit sits below (after, in the printed tree) the exchange.
        assert partial > exchange > -1, plan
