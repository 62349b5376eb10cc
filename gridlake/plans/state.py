"""Pipeline state derived from the driver tables, as the plans read it.

``serving`` is the hourly serving table after a full-history recompute of
bronze; ``daily`` its daily counterpart. Both stay lazy DataFrames so that each
query's filters and column choices reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from gridlake.functions.time import ts_literal
from gridlake.operators import medallion as M
from gridlake.sources import fixtures as X


def as_of() -> Column:
    return ts_literal(X.AS_OF)


def previous_run() -> Column:
    return ts_literal(X.PREVIOUS_RUN)


def bronze(spark: SparkSession, sf_dir: str, since: Column | None = None, through: Column | None = None) -> DataFrame:
    return X.observations(spark, sf_dir, since=since, through=through)


def silver(spark: SparkSession, sf_dir: str, since_hours: int | None = None) -> DataFrame:
    return M.silver(bronze(spark, sf_dir), as_of(), since_hours)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.gold_daily(silver(spark, sf_dir), as_of())


def serving(spark: SparkSession, sf_dir: str, since: Column | None = None, through: Column | None = None) -> DataFrame:
    """The hourly serving table; ``since`` and ``through`` are bounds on the delivery hour
    that the reader applies as well (they reach the scan)."""
    return M.serving_hourly(M.silver(bronze(spark, sf_dir, since, through), as_of()))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.serving_daily(gold(spark, sf_dir))
