"""Partition publishing, pruned merges, compaction, recovery, jobs."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from gridlake import lake as L
from gridlake.jobs import ingest, transform, upkeep
from gridlake.plans import state
from gridlake.schemas import BRONZE
from gridlake.sinks import tables as TB
from gridlake.sources import fixtures as X
from tests.conftest import SF_SMALL

T0 = dt.datetime(2026, 1, 6, 0, 0)


def bronze_rows(spark, data):
    return L.with_delivery_date(spark.createDataFrame(data, BRONZE))


def test_merge_into_converges_and_replays_are_idempotent(spark, scratch):
    lake = L.Lake(scratch)
    path = lake.path(L.BRONZE)
    a = bronze_rows(spark, [("DE-LU", T0, 100.0, "a", T0 + dt.timedelta(hours=10))])
    b = bronze_rows(spark, [("DE-LU", T0, 120.0, "b", T0 + dt.timedelta(hours=11)),
                            ("DE-LU", T0 + dt.timedelta(days=1), 7.0, "b", T0)])
    TB.merge_into(spark, path, BRONZE, a, L.BRONZE.keys, L.BRONZE.partition_cols, "b1")
    TB.merge_into(spark, path, BRONZE, b, L.BRONZE.keys, L.BRONZE.partition_cols, "b2")
    TB.merge_into(spark, path, BRONZE, a, L.BRONZE.keys, L.BRONZE.partition_cols, "b3")  # old replay
    rows = sorted((r.delivery_ts, r.price_eur_mwh, r.source) for r in spark.read.parquet(path).collect())
    assert rows == [(T0, 120.0, "b"), (T0 + dt.timedelta(days=1), 7.0, "b")]


def _merge(spark, path, rows, batch_id):
    TB.merge_into(spark, path, BRONZE, rows, L.BRONZE.keys, L.BRONZE.partition_cols, batch_id)


def test_merge_scans_the_touched_folders_only(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    days = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(days=d), 1.0, "a", T0) for d in range(5)])
    TB.write_partitions(spark, days, path, "init", L.BRONZE.partition_cols)
    batch = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(days=d), 2.0, "b", T0 + dt.timedelta(hours=1)) for d in (0, 3)])
    target = TB.touched_target(spark, path, batch, L.BRONZE.partition_cols)
    plan = target._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert "2026-01-06" in plan and "2026-01-09" in plan and "delivery_date" in filters
    assert target.count() == 2


def test_silver_merge_evaluates_its_batch_once(spark, scratch):
    from pyspark import StorageLevel

    path = L.Lake(scratch).path(L.BRONZE)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(hours=h), 1.0, "a", T0) for h in range(30)])
    counted = rows.mapInArrow(count, rows.schema)
    for version in ("fetched_at", None):
        before = seen.value
        TB.merge_into(spark, path, BRONZE, counted, L.BRONZE.keys, L.BRONZE.partition_cols, f"once-{version}", version=version)
        assert seen.value - before == 30
    assert counted.select(*counted.columns).storageLevel == StorageLevel.NONE


def test_a_partition_gets_one_file_until_it_is_large(spark, scratch, monkeypatch):
    path = L.Lake(scratch).path(L.BRONZE)
    rows = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(minutes=m), 1.0, "a", T0) for m in range(600)]).repartition(8)
    _merge(spark, path, rows, "m1")
    assert [r.files for r in TB.table_files(spark, path, ["delivery_date"]).collect()] == [1]
    monkeypatch.setattr(TB, "TARGET_FILE_BYTES", 1000)
    dealt = TB.deal(rows, path, L.BRONZE.partition_cols)  # a day over several files from here on
    assert dealt._jdf.queryExecution().logical().toString().count("pmod(") == 1
    large = sum(TB.file_sizes(spark, path, L.BRONZE.partition_cols)["delivery_date=2026-01-06"])
    assert f", {-(-large // 1000)})" in dealt._jdf.queryExecution().logical().toString()


def test_recovery_never_takes_newer_rows_back(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    hour = dt.timedelta(hours=1)
    TB.stage(bronze_rows(spark, [("A", T0, 1.0, "a", T0)]), path, "a1", L.BRONZE.partition_cols)  # then a crash
    _merge(spark, path, bronze_rows(spark, [("A", T0, 2.0, "b", T0 + hour), ("B", T0, 3.0, "b", T0 + hour)]), "a2")
    TB.recover(spark, path, L.BRONZE.partition_cols)
    got = sorted((r.region, r.price_eur_mwh) for r in spark.read.parquet(path).collect())
    assert got == [("A", 2.0), ("B", 3.0)]


def test_a_crash_while_publishing_is_finished(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    rows = bronze_rows(spark, [("A", T0 + dt.timedelta(days=d), float(d), "a", T0) for d in range(3)])
    staged = TB.stage(rows, path, "b1", L.BRONZE.partition_cols)
    TB._rename(spark, f"{staged}/delivery_date=2026-01-07", f"{path}/delivery_date=2026-01-07")
    assert TB.recover(spark, path, L.BRONZE.partition_cols) == ["b1"]
    assert sorted(r.price_eur_mwh for r in spark.read.parquet(path).collect()) == [0.0, 1.0, 2.0]


def test_one_writer_at_a_time(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    rows = bronze_rows(spark, [("A", T0, 1.0, "a", T0)])
    TB.acquire(spark, path, "other", L.BRONZE.partition_cols)  # its writer is at work, or died before staging
    with pytest.raises(TB.TableBusy):
        _merge(spark, path, rows, "mine")
    _merge(spark, path, rows, "other")  # a replay of the same batch goes on
    TB.acquire(spark, path, "third", L.BRONZE.partition_cols)
    TB.stage(bronze_rows(spark, [("A", T0, 5.0, "c", T0 + dt.timedelta(hours=9))]), path, "third", L.BRONZE.partition_cols)
    _merge(spark, path, rows, "mine")  # the complete copy is recovered, then merged into
    assert [r.price_eur_mwh for r in spark.read.parquet(path).collect()] == [5.0]
    TB.acquire(spark, path, "gone", L.BRONZE.partition_cols)
    TB.break_lock(spark, path)
    _merge(spark, path, rows, "mine-2")


def test_poison_prices_stop_nothing(spark, scratch):
    from gridlake.sources import messages as MSG

    body = '{{"region":"A","delivery_ts":"2026-01-06T{0:02d}:00:00+00:00","price_eur_mwh":{1},"fetched_at":"2026-01-06T01:00:00+00:00"}}'
    values = [body.format(h, p) for h, p in enumerate(("1.5", "Infinity", "1e300", "-99999999.99", "NaN"))]
    raw = spark.createDataFrame([("k", v, T0) for v in values], "key string, value string, timestamp timestamp")
    classified = MSG.classify(MSG.decode(raw))
    lake = L.Lake(scratch)
    _merge(spark, lake.path(L.BRONZE), L.with_delivery_date(MSG.valid_rows(classified)), "b")
    transform.run_transform(spark, lake, "2026-01-07 00:00:00")
    gold = spark.read.parquet(lake.path(L.GOLD_DAILY)).first()
    assert (gold.min_price, gold.max_price) == (-99999999.99, 1.5)
    assert MSG.rejected_rows(classified).count() == 3


def test_crash_between_stage_and_publish_is_recovered(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    rows = bronze_rows(spark, [("DE-LU", T0, 1.0, "a", T0)])
    TB.stage(rows, path, "b1", L.BRONZE.partition_cols)
    assert not TB.has_data(spark, path)
    assert TB.recover(spark, path, L.BRONZE.partition_cols) == ["b1"]
    assert spark.read.parquet(path).count() == 1
    assert TB.recover(spark, path, L.BRONZE.partition_cols) == []


def test_compaction_rewrites_small_files_once(spark, scratch):
    path = L.Lake(scratch).path(L.BRONZE)
    for h in range(4):
        one = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(hours=h), 50.0 + h, "a", T0)])
        one.write.mode("append").partitionBy("delivery_date").parquet(path)
    before = TB.table_files(spark, path, ["delivery_date"]).first()
    assert (before.files, before.rows) == (4, 4)
    assert TB.compact(spark, path, ["delivery_date"], "c1", min_input_files=5) == {"rewritten_files": 0, "added_files": 0}
    result = TB.compact(spark, path, ["delivery_date"], "c2", min_input_files=4)
    assert result == {"rewritten_files": 4, "added_files": 1}
    after = TB.table_files(spark, path, ["delivery_date"]).first()
    assert (after.files, after.rows) == (1, 4)
    assert TB.compact(spark, path, ["delivery_date"], "c3", min_input_files=2)["rewritten_files"] == 0


def test_transform_job_matches_the_queries(spark, scratch):
    lake = L.Lake(scratch)
    bronze = L.with_delivery_date(X.observations(spark, SF_SMALL))
    TB.merge_into(spark, lake.path(L.BRONZE), BRONZE, bronze, L.BRONZE.keys, L.BRONZE.partition_cols, "load")
    transform.run_transform(spark, lake, X.AS_OF, since_hours=None)
    silver = spark.read.parquet(lake.path(L.SILVER)).drop("delivery_date")
    want = state.silver(spark, SF_SMALL)
    assert sorted(map(tuple, silver.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    gold = spark.read.parquet(lake.path(L.GOLD_DAILY))
    want_gold = state.gold(spark, SF_SMALL)
    assert sorted(map(tuple, gold.select(*want_gold.columns).collect())) == sorted(map(tuple, want_gold.collect()))
    assert spark.read.parquet(lake.path(L.SERVING_DAILY)).count() == want_gold.count()
    # A second run over a 168 h window leaves older days untouched.
    transform.run_transform(spark, lake, X.AS_OF)
    assert spark.read.parquet(lake.path(L.GOLD_DAILY)).count() == want_gold.count()
    health = upkeep.check_freshness(spark, lake, X.AS_OF)
    assert health["status"] == "ok"
    assert spark.read.parquet(lake.path(L.PIPELINE_HEALTH)).count() == 1
    upkeep.check_freshness(spark, lake, "2024-02-05 12:00:00")
    rows = spark.read.parquet(lake.path(L.PIPELINE_HEALTH)).collect()
    assert len(rows) == 1 and rows[0].status == "fail"


def test_news_keys_stay_one_row_whatever_their_dates(spark, scratch):
    lake = L.Lake(scratch)
    page = "<rss><channel><item><title>T</title><link>https://e.test/1</link>{}</item></channel></rss>"
    days = ["", "<pubDate>2025-05-01T10:00:00Z</pubDate>", "<pubDate>2025-05-03T10:00:00Z</pubDate>", ""]
    for k, date in enumerate(days):  # undated alone, then dated, moved, undated again
        feed = spark.createDataFrame([("https://e.test/feed", page.format(date))], "url string, xml string")
        ingest.ingest_news(spark, lake, feed, None, f"2025-05-0{k + 4} 00:00:00")
        rows = spark.read.parquet(lake.path(L.NEWS)).collect()
        want = [None, dt.datetime(2025, 5, 1, 10), dt.datetime(2025, 5, 3, 10), None][k]
        assert [(r.link, r.published_ts) for r in rows] == [("https://e.test/1", want)]


def test_backfill_from_chunks(spark, scratch):
    lake = L.Lake(scratch)
    chunks = spark.createDataFrame(
        [("DE-LU", 1, '{"series":[[1788451200000,1.5],[1788454800000,null]]}')],
        "region string, week_start_ms bigint, text string",
    )
    ingest.backfill(spark, lake, chunks, "2026-09-10 00:00:00")
    assert spark.read.parquet(lake.path(L.BRONZE)).count() == 1
    empty = chunks.where(F.lit(False))
    try:
        ingest.backfill(spark, lake, empty, "2026-09-10 00:00:00")
    except ingest.NothingToLoad:
        pass
    else:
        raise AssertionError("empty backfill must fail")


def test_expiry_keeps_the_newest_copies_and_rejects_naive_cutoffs(spark, scratch):
    import time as _time

    path = L.Lake(scratch).path(L.BRONZE)
    for i in range(4):
        rows = bronze_rows(spark, [("DE-LU", T0 + dt.timedelta(days=i), 1.0, "a", T0)])
        TB.write_partitions(spark, rows, path, f"b{i}", L.BRONZE.partition_cols)
        _time.sleep(0.05)
    TB.stage(bronze_rows(spark, [("DE-LU", T0, 2.0, "a", T0)]), path, "unpublished", L.BRONZE.partition_cols)
    try:
        TB.expire_staged(spark, path, dt.datetime(2100, 1, 1), 1)
    except ValueError:
        pass
    else:
        raise AssertionError("naive cutoff must be rejected")
    future = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)
    assert TB.expire_staged(spark, path, future, retain_last=2) == 2
    left = sorted(c.rstrip("/").split("/")[-1] for c in TB._children(spark, TB.staging_dir(path)))
    assert left == ["b2", "b3", "unpublished"]
    assert spark.read.parquet(path).count() == 4
    past = dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)
    assert TB.expire_staged(spark, path, past, retain_last=0) == 0


def test_compaction_of_an_unpartitioned_table(spark, scratch):
    path = f"{scratch}/flat"
    for i in range(3):
        spark.createDataFrame([(i, "x")], "i int, s string").coalesce(1).write.mode("append").parquet(path)
    assert TB.compact(spark, path, [], "c1", min_input_files=3) == {"rewritten_files": 3, "added_files": 1}
    assert sorted(r.i for r in spark.read.parquet(path).collect()) == [0, 1, 2]
