"""Structured Streaming ingest and change-only emission."""

from __future__ import annotations

import datetime as dt
import glob
import os
import shutil

from pyspark.sql import functions as F

from gridlake import lake as L
from gridlake.operators.revisions import latest_revision
from gridlake.schemas import KEYS
from gridlake.sources import fixtures as X
from gridlake.sources import messages as MSG
from gridlake.streaming.changes import changed_points
from gridlake.streaming.ingest import file_messages, start_ingest
from tests.conftest import SF_SMALL


def _land(df, inbox, name):
    """Write one JSON-lines file into ``inbox`` (as a producer would)."""
    tmp = f"{inbox}_tmp_{name}"
    df.coalesce(1).write.mode("overwrite").json(tmp)
    part = glob.glob(f"{tmp}/part-*.json")[0]
    os.makedirs(inbox, exist_ok=True)
    shutil.copy(part, f"{inbox}/{name}.json")


def _messages(spark, batch):
    events = X.events_for_messages(spark, SF_SMALL).where(F.col("event_id") % 2 == batch)
    return MSG.fixture_messages(events).select("key", "value", F.col("timestamp"))


def _expected_bronze(spark):
    classified = MSG.classify(MSG.decode(MSG.fixture_messages(X.events_for_messages(spark, SF_SMALL))))
    return sorted(tuple(r) for r in latest_revision(MSG.valid_rows(classified), KEYS).collect())


def _bronze(spark, lake):
    return sorted(tuple(r) for r in spark.read.parquet(lake.path(L.BRONZE)).drop("delivery_date").select(
        "region", "delivery_ts", "price_eur_mwh", "source", "fetched_at").collect())


def test_stream_converges_to_the_batch_answer_and_survives_restart(spark, scratch):
    lake = L.Lake(f"{scratch}/lake")
    inbox, ckpt = f"{scratch}/inbox", f"{scratch}/checkpoint"
    _land(_messages(spark, 1), inbox, "001")
    _land(_messages(spark, 0), inbox, "002")
    q = start_ingest(file_messages(spark, inbox, max_files_per_trigger=1), lake, ckpt, {"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    assert _bronze(spark, lake) == _expected_bronze(spark)
    rejects = spark.read.parquet(lake.path(L.REJECTS))
    classified = MSG.classify(MSG.decode(MSG.fixture_messages(X.events_for_messages(spark, SF_SMALL))))
    assert rejects.count() == MSG.rejected_rows(classified).count()
    assert rejects.select("batch_id").distinct().count() == 2

    # Restart on the same checkpoint: only the new (replayed, older) file is read.
    _land(_messages(spark, 1), inbox, "003")
    q = start_ingest(file_messages(spark, inbox, max_files_per_trigger=1), lake, ckpt, {"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    assert _bronze(spark, lake) == _expected_bronze(spark)
    assert spark.read.parquet(lake.path(L.REJECTS)).select("batch_id").distinct().count() == 3

    # Another checkpoint counts its batches from 0 again: nothing of the first is lost.
    before = spark.read.parquet(lake.path(L.REJECTS)).count()
    q = start_ingest(file_messages(spark, inbox, max_files_per_trigger=3), lake, f"{ckpt}-2", {"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    assert spark.read.parquet(lake.path(L.REJECTS)).count() == 2 * before


def test_changed_points_stream(spark, scratch):
    inbox = f"{scratch}/points"
    t0 = dt.datetime(2026, 9, 7, 0, 0)
    rows = [("DE-LU", t0, p, t0 + dt.timedelta(minutes=m)) for m, p in [(0, 10.0), (1, 10.0), (2, 11.0)]]
    rows += [("DE-LU", t0 + dt.timedelta(hours=1), 5.0, t0)]
    schema = "region string, delivery_ts timestamp, price_eur_mwh double, fetched_at timestamp"
    _land(spark.createDataFrame(rows, schema), inbox, "a")
    later = [("DE-LU", t0, 11.0, t0 + dt.timedelta(minutes=5)), ("DE-LU", t0, 12.0, t0 + dt.timedelta(minutes=6))]
    _land(spark.createDataFrame(later, schema), inbox, "b")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(inbox)
    q = (
        changed_points(stream)
        .writeStream.format("memory")
        .queryName("changed_test")
        .option("checkpointLocation", f"{scratch}/ckpt")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(600)
    got = sorted((r.delivery_ts, r.price_eur_mwh) for r in spark.table("changed_test").collect())
    assert got == [(t0, 10.0), (t0, 11.0), (t0, 12.0), (t0 + dt.timedelta(hours=1), 5.0)]


def _run(spark, inbox, scratch, schema, name, **options):
    stream = spark.readStream.schema(schema).json(inbox)
    q = changed_points(stream, **options).writeStream.format("parquet").option("path", f"{scratch}/{name}")
    q = q.option("checkpointLocation", f"{scratch}/{name}-ckpt").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(600)
    assert q.exception() is None
    return sorted((r.delivery_ts.day, r.price_eur_mwh) for r in spark.read.schema(schema).parquet(f"{scratch}/{name}").collect())


def test_late_keys_are_emitted_and_old_unchanged_hours_are_not(spark, scratch):
    inbox, schema = f"{scratch}/inbox", "region string, delivery_ts timestamp, price_eur_mwh double, fetched_at timestamp"
    day = lambda d, h=0: dt.datetime(2025, 4, d, h)
    polls = [
        [("R", day(1), 10.0, day(1))],
        [("R", day(28), 5.0, day(28))],
        [("R", day(1), 10.0, day(29)), ("R", day(2), 7.0, day(2))],  # old hour unchanged; a key 27 days late
        [("R", day(1), 10.0, day(30)), ("R", day(1), 11.0, day(30, 1))],
    ]
    want = [[(1, 10.0)], [(1, 10.0), (28, 5.0)], [(1, 10.0), (2, 7.0), (28, 5.0)], [(1, 10.0), (1, 11.0), (2, 7.0), (28, 5.0)]]
    for k, rows in enumerate(polls):
        _land(spark.createDataFrame(rows, schema), inbox, str(k))
        assert _run(spark, inbox, scratch, schema, "out") == want[k]
