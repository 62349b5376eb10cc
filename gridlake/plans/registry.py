"""Named queries: a Spark plan and, where SQL can state it, an oracle.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose timestamp
columns are UTC wall-clock ``timestamp_ntz`` values (the oracle's type).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from gridlake.session import ensure_utc

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None


_QUERIES: dict[str, Query] = {}


def wall_clock(df: DataFrame) -> DataFrame:
    """Cast instant columns to ``timestamp_ntz`` (UTC wall clock)."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return wall_clock(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = Query(name, run, sql)
        return fn

    return wrap


def _load() -> None:
    # Importing the plan modules registers their queries.
    from gridlake.plans import bi, dashboard, files, medallion, messages, news, pulse, upkeep  # noqa: F401, I001
    from gridlake.plans import lake, views  # noqa: F401  # build on the others' oracles


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def queries() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in all_queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in all_queries().items() if q.sql is not None}
