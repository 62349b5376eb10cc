"""What the jobs write, read back from the lake they wrote it to."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridlake import lake as L
from gridlake.jobs import ingest, transform, upkeep
from gridlake.plans import messages, news, pulse  # noqa: F401  (registers freshness)
from gridlake.plans import sql as S
from gridlake.plans.registry import _QUERIES, query
from gridlake.schemas import BRONZE, PIPELINE_HEALTH, SERVING_DAILY, SERVING_HOURLY
from gridlake.session import ensure_checkpoint_dir
from gridlake.sinks import files as FS
from gridlake.sinks import tables as TB
from gridlake.sources import feeds as FD
from gridlake.sources import fixtures as X
from gridlake.sources import messages as MSG


def _new(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridlake-{name}-{uuid.uuid4().hex}"


def loaded(spark, sf_dir):
    """A lake with all observations in bronze (two loads) and everything recomputed."""
    lake = L.Lake(_new(spark, "served"))
    for batch in (1, 0):
        rows = L.with_delivery_date(X.observations(spark, sf_dir, batch=batch))
        TB.merge_into(spark, lake.path(L.BRONZE), BRONZE, rows, L.BRONZE.keys, L.BRONZE.partition_cols, f"load-{batch}")
    transform.run_transform(spark, lake, X.AS_OF, since_hours=None, run_id="full")
    return lake


def _read(spark, lake, table, schema):
    return TB.read_table(spark, lake.path(table), L.stored(schema, table)).select(*schema.fieldNames())


@query("lake_serving_hourly", S.with_(*S.SERVING_CTES) + f"SELECT {', '.join(SERVING_HOURLY.fieldNames())} FROM serving")
def lake_serving_hourly(spark, sf_dir):
    """K3: the hourly serving table as the transform job left it."""
    return _read(spark, loaded(spark, sf_dir), L.SERVING_HOURLY, SERVING_HOURLY)


@query("lake_serving_daily", S.with_(*S.DAILY_CTES) + f"SELECT {', '.join(SERVING_DAILY.fieldNames())} FROM daily")
def lake_serving_daily(spark, sf_dir):
    """K3: the daily serving table as the transform job left it."""
    return _read(spark, loaded(spark, sf_dir), L.SERVING_DAILY, SERVING_DAILY)


_DAILY_VALUES = "region, local_day, avg_price, min_price, max_price, negative_hours"
#: One region's first day arrives weeks late, long after the window of the hourly job.
LATE_REGION, LATE_DAY = "purchase", "2024-01-01"


@query("lake_late_revision", S.with_(*S.DAILY_CTES) + f"SELECT {_DAILY_VALUES} FROM daily")
def lake_late_revision(spark, sf_dir):
    """Revisions older than the window are served once the changed days are recomputed."""
    lake = L.Lake(_new(spark, "late"))
    rows = L.with_delivery_date(X.observations(spark, sf_dir))
    is_late = (F.col("region") == LATE_REGION) & (F.col("delivery_date") == F.lit(LATE_DAY).cast("date"))
    ingest.merge_bronze(spark, lake, rows.where(~is_late), "load-1")
    transform.run_changed_days(spark, lake, X.PREVIOUS_RUN, run_id="changed-1")
    ingest.merge_bronze(spark, lake, rows.where(is_late), "load-2")
    transform.run_transform(spark, lake, X.AS_OF, run_id="window")
    transform.run_changed_days(spark, lake, X.AS_OF, run_id="changed-2")
    return _read(spark, lake, L.SERVING_DAILY, SERVING_DAILY).select(*_DAILY_VALUES.split(", "))


@query("lake_health", _QUERIES["freshness"].sql)
def lake_health(spark, sf_dir):
    """The health table after two checks (the second replaces the first)."""
    lake = loaded(spark, sf_dir)
    upkeep.check_freshness(spark, lake, "2024-02-05 12:00:00")
    upkeep.check_freshness(spark, lake, X.AS_OF)
    return _read(spark, lake, L.PIPELINE_HEALTH, PIPELINE_HEALTH)


@query(
    "lake_compacted",
    S.with_(("obs", S.obs()), ("latest", S.latest()))
    + "SELECT CAST(delivery_ts AS DATE) AS delivery_date, count(*) AS \"rows\", CAST(1 AS BIGINT) AS files FROM latest GROUP BY 1",
)
def lake_compacted(spark, sf_dir):
    """M1: bronze appended in many small files, then compacted: every row is still there,
    in one file a day."""
    lake = L.Lake(_new(spark, "compacted"))
    path = lake.path(L.BRONZE)
    rows = L.with_delivery_date(messages.latest_revision_q(spark, sf_dir))
    rows.repartition(6).write.partitionBy(*L.BRONZE.partition_cols).parquet(path)
    upkeep.maintain(spark, lake, "compact", min_input_files=2, tables=(L.BRONZE,))
    return TB.table_files(spark, path, L.BRONZE.partition_cols)


@query(
    "stream_rejects",
    f"SELECT key, value, reason, date_trunc('milliseconds', kafka_ts) AS kafka_ts FROM ({_QUERIES['dead_letters'].sql}) d",
)
def stream_rejects(spark, sf_dir):
    """What the ingest stream filed as rejected, read back (the landed envelopes
    carry milliseconds, as a topic does)."""
    lake = messages.stream_lake(spark, sf_dir)
    return spark.read.parquet(lake.path(L.REJECTS)).select("key", "value", "reason", "kafka_ts")


HEAD = 10


@query(
    "head_headlines",
    f"""SELECT source, link, title FROM ({news._RUN_2}) r
ORDER BY source, 'https://' || source || '/feed/' || CAST(CAST(regexp_extract(link, '([0-9]+)$', 1) AS BIGINT) // {X.FEED_BLOCK} AS VARCHAR),
         CAST(regexp_extract(link, '([0-9]+)$', 1) AS BIGINT) LIMIT {HEAD}""",
)
def head_headlines(spark, sf_dir):
    """The first headlines in feed order (the limit is the feature)."""
    return FD.first_headlines(X.feed_documents(spark, sf_dir), HEAD).select("source", "link", "title")


@query("headline_lines", f"SELECT source, link, title, category FROM ({news._RUN_2}) r")
def headline_lines(spark, sf_dir):
    """K7: the classified headlines as JSON lines, read back."""
    path = _new(spark, "headlines")
    FS.write_headlines(news.run_two(spark, sf_dir), path)
    return spark.read.schema("source string, link string, title string, category string").json(path).select(
        "source", "link", "title", "category"
    )
