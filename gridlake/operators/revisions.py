"""Keys, revisions and upserts.

``latest_revision`` keeps the newest row per natural key. It is written as a
``row_number() = 1`` filter, which Catalyst turns into a partial
``WindowGroupLimit`` before the exchange: every map task forwards at most one
row per key, so a key holding a third of all revisions does not land whole in
one reducer.

``revision_merge`` is the revision-aware MERGE (update only when the incoming
version is strictly newer, insert when unmatched) expressed as a union plus the
same top-1; ``upsert`` is the unconditional MERGE as anti-join plus union.
Both are equal to MERGE when the target holds one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ORIGIN = "__origin"
_RN = "__rn"


def _order(version: str, tie_break: Sequence[str]) -> list[Column]:
    # Newest first; equal versions are broken by the remaining columns so the
    # result never depends on task order.
    return [F.col(version).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tie_break]


def latest_revision(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "fetched_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``version``, ties broken by ``tie_break``."""
    keys = list(keys)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != version]
    window = Window.partitionBy(*keys).orderBy(*_order(version, tie_break))
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def revision_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    version: str = "fetched_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Target after ``MERGE ... WHEN MATCHED AND s.version > t.version THEN
    UPDATE WHEN NOT MATCHED THEN INSERT`` with the batch's newest row per key.

    Rows with a NULL key or version are dropped from the batch: a MERGE could
    never match them again, so each replay would add another copy.
    """
    keys = list(keys)
    columns = target.columns
    if tie_break is None:
        tie_break = [c for c in columns if c not in keys and c != version]
    valid = F.lit(True)
    for c in [*keys, version]:
        valid = valid & F.col(c).isNotNull()
    # One ranking over stored + incoming rows: the greatest version wins, the
    # stored row first among equal versions (an update needs a strictly newer
    # one), incoming rows of equal version by the tie-break. That equals
    # "newest incoming row per key, then MERGE", with one shuffle.
    both = target.select(*columns, F.lit(0).alias(_ORIGIN)).unionByName(
        batch.select(*columns).where(valid).select(*columns, F.lit(1).alias(_ORIGIN))
    )
    window = Window.partitionBy(*keys).orderBy(
        F.col(version).desc_nulls_last(), F.col(_ORIGIN).asc(), *[F.col(c).asc_nulls_first() for c in tie_break]
    )
    return both.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN, _ORIGIN)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after ``MERGE ... WHEN MATCHED THEN UPDATE (all) WHEN NOT MATCHED
    THEN INSERT``; the batch must hold one row per key."""
    keys = list(keys)
    kept = target.join(batch.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(batch.select(*target.columns))


def changed_rows(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    version: str = "fetched_at",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose ``value`` is new for the key or differs from the previous
    revision of the key (NULL-safe), in ``version`` order.

    Hot keys: rows are range-partitioned on ``(keys, version, tie_break)``, so
    one key's revisions may span many tasks. ``lag`` runs per (partition, key);
    only the first row of a partition can have its predecessor in another
    partition, namely the last row of the nearest earlier non-empty one. Those
    tails form a table with one row per partition (bounded by the partition
    count), which is broadcast and equi-joined on the partition id.
    """
    keys = list(keys)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in (version, value)]
    order = [*keys, version, *tie_break]
    pid = "__pid"
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn(
        pid, F.spark_partition_id()
    )
    run = Window.partitionBy(pid, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in [version, *tie_break]])
    in_part = Window.partitionBy(pid).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    with_prev = (
        ranged.withColumn("__prev", F.lag(F.col(value)).over(run))
        .withColumn("__has_prev", F.row_number().over(run) > 1)
        .withColumn("__first_in_part", F.row_number().over(in_part) == 1)
    )
    # One row per non-empty partition: its last key and value.
    tail_order = Window.partitionBy(pid).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = (
        ranged.withColumn("__rt", F.row_number().over(tail_order))
        .where(F.col("__rt") == 1)
        .select(pid, *[F.col(k).alias(f"__t_{k}") for k in keys], F.col(value).alias("__t_value"))
    )
    # Predecessor tail of each partition; a window over <= #partitions rows.
    by_pid = Window.orderBy(pid)
    boundary = tails.select(
        pid,
        *[F.lag(f"__t_{k}").over(by_pid).alias(f"__b_{k}") for k in keys],
        F.lag("__t_value").over(by_pid).alias("__b_value"),
        (F.row_number().over(by_pid) > 1).alias("__b_exists"),
    )
    joined = with_prev.join(F.broadcast(boundary), on=pid, how="left")
    crosses = F.col("__first_in_part") & F.coalesce(F.col("__b_exists"), F.lit(False))
    for k in keys:
        crosses = crosses & F.col(f"__b_{k}").eqNullSafe(F.col(k))
    has_prev = F.col("__has_prev") | crosses
    prev = F.when(crosses, F.col("__b_value")).otherwise(F.col("__prev"))
    emitted = ~has_prev | ~prev.eqNullSafe(F.col(value))
    return joined.where(emitted).select(*df.columns)
