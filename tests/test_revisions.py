"""Revision-aware merge, latest revision, upsert and change detection."""

from __future__ import annotations

import datetime as dt
import random


from pyspark.sql import functions as F

from gridlake.operators.revisions import changed_rows, latest_revision, revision_merge, upsert
from gridlake.schemas import BRONZE, KEYS

T0 = dt.datetime(2026, 1, 6, 0, 0)


def rows(spark, data):
    return spark.createDataFrame(data, BRONZE)


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def obs(hour, price, fetched_hour, source="api", region="DE-LU"):
    return (region, T0 + dt.timedelta(hours=hour), float(price), source, T0 + dt.timedelta(hours=fetched_hour))


def test_newer_revision_replaces_including_source(spark):
    stored = rows(spark, [obs(0, 100, 10, "a")])
    batch = rows(spark, [obs(0, 120, 11, "b")])
    assert as_set(revision_merge(stored, batch, KEYS)) == [obs(0, 120, 11, "b")]


def test_older_revision_never_regresses(spark):
    stored = rows(spark, [obs(0, 120, 11, "b")])
    batch = rows(spark, [obs(0, 100, 10, "a")])
    assert as_set(revision_merge(stored, batch, KEYS)) == [obs(0, 120, 11, "b")]


def test_equal_version_keeps_stored_row(spark):
    stored = rows(spark, [obs(0, 120, 11, "b")])
    batch = rows(spark, [obs(0, 1, 11, "a")])
    assert as_set(revision_merge(stored, batch, KEYS)) == [obs(0, 120, 11, "b")]


def test_newest_of_in_batch_duplicates_kept(spark):
    stored = rows(spark, [])
    batch = rows(spark, [obs(0, 90, 9), obs(0, 95, 10)])
    assert as_set(revision_merge(stored, batch, KEYS)) == [obs(0, 95, 10)]


def test_null_keys_and_versions_are_dropped(spark):
    stored = rows(spark, [])
    batch = rows(spark, [obs(0, 1, 1, region=None), (("DE-LU", None, 1.0, "a", T0)), ("DE-LU", T0, 1.0, "a", None)])
    assert revision_merge(stored, batch, KEYS).count() == 0


def test_replay_converges_in_any_order(spark):
    rng = random.Random(7)
    data = [obs(rng.randrange(6), rng.randrange(-20, 200), f, rng.choice("ab")) for f in range(60)]
    truth = {}
    for r in data:
        k = (r[0], r[1])
        if k not in truth or r[4] > truth[k][4]:
            truth[k] = r
    expected = sorted(truth.values())
    for _ in range(3):
        rng.shuffle(data)
        parts = [data[i::3] for i in range(3)]
        state = rows(spark, [])
        for part in parts + parts[:1]:  # the first batch is replayed at the end
            state = revision_merge(state, rows(spark, part), KEYS)
        assert as_set(state) == expected


def test_latest_revision_one_row_per_key(spark):
    batch = rows(spark, [obs(0, 1, 1), obs(0, 2, 3), obs(1, 5, 2)])
    assert as_set(latest_revision(batch, KEYS)) == [obs(0, 2, 3), obs(1, 5, 2)]


def test_upsert_replaces_and_inserts(spark):
    stored = rows(spark, [obs(0, 1, 1), obs(1, 1, 1)])
    batch = rows(spark, [obs(1, 9, 0), obs(2, 9, 0)])
    assert as_set(upsert(stored, batch, KEYS)) == [obs(0, 1, 1), obs(1, 9, 0), obs(2, 9, 0)]


def _changed_brute(data):
    out, last = [], {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[3], r[2])):
        k = (r[0], r[1])
        if k not in last or last[k] != r[2]:
            out.append(r)
        last[k] = r[2]
    return sorted(out)


def test_changed_rows_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    # One key holds most revisions, so it spans many range partitions.
    data = [("hot", T0, float(rng.choice([1, 1, 2, 3])), T0 + dt.timedelta(seconds=i)) for i in range(3000)]
    data += [("cold", T0 + dt.timedelta(hours=h), float(rng.choice([1, 2])), T0 + dt.timedelta(seconds=i)) for h in range(5) for i in range(20)]
    df = spark.createDataFrame(data, "region string, delivery_ts timestamp, price double, fetched_at timestamp")
    got = changed_rows(df.repartition(7), KEYS, "price", "fetched_at")
    # 16 range partitions, not coalesced: the hot key must span several tasks
    # so that the partition-boundary path is exercised.
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got_rows = sorted(tuple(r) for r in got.collect())
        spread = (
            df.repartitionByRange("region", "delivery_ts", "fetched_at")
            .where(F.col("region") == "hot")
            .select(F.spark_partition_id().alias("p"))
            .distinct()
            .count()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 4
    assert got_rows == _changed_brute(data)


def test_latest_revision_plan_limits_before_the_shuffle(spark):
    df = rows(spark, [obs(0, 1, 1)])
    plan = latest_revision(df, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
