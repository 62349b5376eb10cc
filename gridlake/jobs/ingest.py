"""Batch loads into bronze and news: backfill from landed week chunks, news
from landed feeds. Both use the same revision-aware merge as the stream."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import lake as L
from gridlake.functions.time import ts_literal
from gridlake.operators import news as N
from gridlake.schemas import BRONZE, NEWS
from gridlake.sinks import tables as TB
from gridlake.sources import feeds as FD
from gridlake.sources import landed


class NothingToLoad(RuntimeError):
    """Raised when a load finds no rows (the reference fails the run too)."""


def merge_bronze(spark: SparkSession, lake: L.Lake, rows: DataFrame, batch_id: str) -> None:
    """Revision-aware merge of rows (with delivery_date) into bronze; then the days it touched go
    to the change log, which ``run_changed_days`` reads. The log comes second: a crash in between
    leaves a merge that is replayed, and logged then."""
    TB.merge_into(spark, lake.path(L.BRONZE), BRONZE, rows, L.BRONZE.keys, L.BRONZE.partition_cols, batch_id)
    touched = rows.groupBy("delivery_date").agg(F.max("fetched_at").alias("newest"))
    logged = touched.select(F.lit(uuid.uuid4().hex).alias("entry_id"), "delivery_date", "newest", F.current_date().alias("logged_day"))
    logged.coalesce(1).write.mode("append").partitionBy("logged_day").parquet(lake.path(L.BRONZE_CHANGES))


def backfill(
    spark: SparkSession,
    lake: L.Lake,
    chunks: DataFrame,
    fetched_at: str | dt.datetime,
    weeks: int = 1,
    source: str = "api",
    batch_id: str | None = None,
) -> None:
    """Newest ``weeks`` chunks per region -> bronze (revision-aware)."""
    points = landed.parse_week_chunks(landed.latest_chunks(chunks, weeks))
    rows = L.with_delivery_date(
        points.select(
            "region", "delivery_ts", "price_eur_mwh", F.lit(source).alias("source"),
            ts_literal(fetched_at).alias("fetched_at"),
        )
    ).persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for the check and the merge
    try:
        if rows.isEmpty():
            raise NothingToLoad("no published points in the landed chunks")
        merge_bronze(spark, lake, rows, batch_id or f"backfill-{str(fetched_at).replace(' ', 'T').replace(':', '')}")
    finally:
        rows.unpersist()


def ingest_news(
    spark: SparkSession,
    lake: L.Lake,
    feeds: DataFrame,
    answers: DataFrame | None,
    fetched_at: str | dt.datetime,
    keep_label: bool = False,
    limit: int = 0,
    batch_id: str | None = None,
) -> dict[str, int]:
    """Feeds -> headlines -> classification -> news table. The headlines' texts are dealt once, by
    key: repeated links, answers, the merge and the written files go by it."""
    tasks = None if limit else TB.dealt_tasks(spark, feeds, lake.path(L.NEWS), L.NEWS.partition_cols, L.NEWS_SLOTS)
    heads = FD.first_headlines(feeds, limit) if limit else FD.parse_feeds(feeds, tasks=tasks)
    batch = L.with_key_slot(N.classify(heads, answers, ts_literal(fetched_at)))
    # Parsed and classified once, for the check, the merge and the counts.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch.isEmpty():
            raise NothingToLoad("no headlines fetched; nothing to ingest")
        batch_id = batch_id or f"news-{str(fetched_at).replace(' ', 'T').replace(':', '')}"
        merge_fn = None
        if keep_label:
            def merge_fn(target, rows):
                return L.with_key_slot(N.merge_news(target, rows, keep_label=True))

        TB.merge_into(
            spark, lake.path(L.NEWS), NEWS, batch, L.NEWS.keys, L.NEWS.partition_cols, batch_id,
            merge_fn=merge_fn, tasks=tasks,
        )
        counts = N.ingest_counts(batch).first()
    finally:
        batch.unpersist()
    return {"total": counts["total"], "classified": counts["classified"], "other": counts["other"]}
