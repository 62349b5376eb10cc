"""Table layout of a lake folder (shared storage: HDFS, S3, ABFS, or local in tests).

Every table is Parquet. Price tables are partitioned by a day column, so that the
recompute window and the merge batches prune whole folders; news by a hash slot of its
key, so that a headline whose publication day changes stays in its partition. A slot is taken
from the hash that Spark deals rows by, so rows dealt by key over a multiple of ``NEWS_SLOTS``
tasks are one slot a task, and are written as they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from gridlake.functions.time import local_ts


@dataclass(frozen=True)
class Table:
    name: str
    partition_cols: tuple[str, ...]
    keys: tuple[str, ...]


BRONZE = Table("bronze_prices", ("delivery_date",), ("region", "delivery_ts"))
SILVER = Table("silver_prices", ("delivery_date",), ("region", "delivery_ts"))
GOLD_DAILY = Table("gold_daily", ("local_day",), ("region", "local_day"))
NEWS = Table("news_events", ("key_slot",), ("source", "link"))
NEWS_SLOTS = 16
SERVING_HOURLY = Table("serving_price_hourly", ("delivery_date",), ("region", "delivery_ts"))
SERVING_DAILY = Table("serving_daily_stats", ("local_day",), ("region", "local_day"))
PIPELINE_HEALTH = Table("serving_pipeline_health", (), ("check_name",))
# What merges into bronze touched (a row per merge and day), and which of it was recomputed.
BRONZE_CHANGES = Table("bronze_changes", ("logged_day",), ())
RECOMPUTED = Table("recomputed_changes", ("logged_day",), ())
REJECTS = Table("rejected_messages", ("run_id", "batch_id"), ())


def delivery_date(ts: Column | str = "delivery_ts") -> Column:
    """UTC day of the instant: the partition of hourly tables."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


def with_delivery_date(df: DataFrame) -> DataFrame:
    return df.withColumn("delivery_date", delivery_date())


def with_key_slot(df: DataFrame) -> DataFrame:
    return df.withColumn("key_slot", F.pmod(F.hash(*NEWS.keys), F.lit(NEWS_SLOTS)).cast("int"))


def stored(schema: StructType, table: Table) -> StructType:
    """A table's declared schema with its partition columns."""
    types = {"delivery_date": DateType(), "key_slot": IntegerType()}
    added = [StructField(c, types[c]) for c in table.partition_cols if c not in schema.fieldNames()]
    return StructType([*schema.fields, *added])


def local_day(ts: Column | str = "delivery_ts") -> Column:
    return F.to_date(local_ts(ts))


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, table: Table) -> str:
        return f"{self.root.rstrip('/')}/{table.name}"
