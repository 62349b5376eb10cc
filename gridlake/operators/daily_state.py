"""Daily aggregates that take revisions in: stored partial states instead of a regrouped day.

A state holds, per (region, local day), the exact sum and count of prices, the count of hours and
of negative hours, and the lowest and highest price each with the number of hours that have it. A
batch of revisions is a table of signed rows: -1 for the hour as it was stored, +1 as it is now.
Sums and counts add up. An extreme is kept while hours with it are left, and replaced when a new
price goes beyond it; only a day whose extreme was taken back by its last hour has to be read
again. Days without hours left have no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.money import avg_exact_price, exact, to_cents

DAY = ["region", "local_day"]
HOUR = ["region", "delivery_ts"]
TOTAL = "decimal(27,8)"
FIELDS = ["total", "priced", "hours", "negative", "low", "n_low", "high", "n_high"]


def _hours(silver_rows: DataFrame, sign: int) -> DataFrame:
    return silver_rows.select(
        "region",
        F.to_date("local_ts").alias("local_day"),
        exact("price_eur_mwh").alias("price"),
        F.coalesce(F.col("is_negative"), F.lit(False)).alias("is_negative"),
        F.lit(sign).alias("sign"),
    )


def signed_rows(stored: DataFrame, now: DataFrame) -> DataFrame:
    """The change from ``stored`` to ``now``, silver rows of the revised hours (``stored`` may hold
    others too): each hour as it was, to be taken back, and as it is."""
    replaced = stored.join(now.select(*HOUR), HOUR, "left_semi")
    return _hours(replaced, -1).unionByName(_hours(now, 1))


def _by_price(rows: DataFrame) -> DataFrame:
    """Signed rows summed up per day and price: came, went, and their negatives."""
    plus, minus = F.col("sign") > 0, F.col("sign") < 0
    return rows.groupBy(*DAY, "price").agg(
        F.count_if(plus).alias("came"),
        F.count_if(minus).alias("went"),
        F.sum(F.col("sign") * F.col("is_negative").cast("int")).alias("negative"),
    )


def _changes() -> list[Column]:
    net = F.col("came") - F.col("went")
    priced = F.col("price").isNotNull()
    new = F.when((F.col("came") > 0) & priced, F.struct("price", F.col("came").alias("n")))
    return [
        F.coalesce(F.sum(net * F.col("price")), F.lit(0)).cast(TOTAL).alias("d_total"),
        F.sum(F.when(priced, net).otherwise(0)).alias("d_priced"),
        F.sum(net).alias("d_hours"),
        F.sum("negative").alias("d_negative"),
        F.min(new).alias("lowest"),
        F.max(new).alias("highest"),
    ]


def states(silver_rows: DataFrame) -> DataFrame:
    """States of whole days."""
    per_price = _by_price(_hours(silver_rows, 1))
    grouped = per_price.groupBy(*DAY).agg(*_changes())
    return grouped.select(
        *DAY, F.col("d_total").alias("total"), F.col("d_priced").alias("priced"), F.col("d_hours").alias("hours"),
        F.col("d_negative").alias("negative"), F.col("lowest.price").alias("low"), F.col("lowest.n").alias("n_low"),
        F.col("highest.price").alias("high"), F.col("highest.n").alias("n_high"),
    )


def _extreme(stored: str, count: str, new: str, went: str, beyond: Column) -> tuple[Column, Column, Column]:
    """(price, count, lost): the extreme after the batch; lost if no hour with it is known."""
    came_price, came_n = F.col(f"{new}.price"), F.col(f"{new}.n")
    have = F.col(stored).isNotNull()
    left = F.coalesce(F.col(count), F.lit(0)) - F.coalesce(F.col(went), F.lit(0))
    more = F.when(came_price == F.col(stored), came_n).otherwise(0)
    takes = came_price.isNotNull() & (~have | beyond)
    price = F.when(takes, came_price).otherwise(F.col(stored))
    n = F.when(takes, came_n).otherwise(left + F.coalesce(more, F.lit(0)))
    return price, n, have & (n <= 0)


def apply(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """States after a batch of signed rows, of the days in it: region, local_day, the state and
    ``lost`` (an extreme must be read again)."""
    per_price = _by_price(changes)
    held = stored.select(*DAY, F.col("low").alias("s_low"), F.col("high").alias("s_high"))
    near = per_price.join(held, DAY, "left")
    went = [F.sum(F.when(F.col("price") == F.col(f"s_{x}"), F.col("went")).otherwise(0)).alias(f"went_{x}") for x in ("low", "high")]
    grouped = near.groupBy(*DAY).agg(*_changes(), *went)
    both = grouped.join(stored.select(*DAY, *FIELDS), DAY, "left")
    added = lambda a, b: (F.coalesce(F.col(a), F.lit(0)) + F.col(b))
    low, n_low, lost_low = _extreme("low", "n_low", "lowest", "went_low", F.col("lowest.price") < F.col("low"))
    high, n_high, lost_high = _extreme("high", "n_high", "highest", "went_high", F.col("highest.price") > F.col("high"))
    return both.select(
        *DAY, added("total", "d_total").cast(TOTAL).alias("total"), added("priced", "d_priced").alias("priced"),
        added("hours", "d_hours").alias("hours"), added("negative", "d_negative").alias("negative"),
        low.alias("low"), n_low.alias("n_low"), high.alias("high"), n_high.alias("n_high"), (lost_low | lost_high).alias("lost"),
    )


def absorb(stored: DataFrame, changes: DataFrame, silver_now: DataFrame) -> DataFrame:
    """All states after a batch: untouched days as stored, revised days updated, and days with a
    lost extreme made again from ``silver_now`` (the hours as they are now)."""
    after = apply(stored, changes)
    lost = after.where("lost AND hours > 0").select(*DAY)
    again = states(silver_now.withColumn("local_day", F.to_date("local_ts")).join(lost, DAY, "left_semi").drop("local_day"))
    kept = stored.join(after.select(*DAY), DAY, "left_anti").select(*DAY, *FIELDS)
    updated = after.where("NOT lost AND hours > 0").select(*DAY, *FIELDS)
    return kept.unionByName(updated).unionByName(again.select(*DAY, *FIELDS))


def gold(state_rows: DataFrame, as_of: Column) -> DataFrame:
    """Daily statistics of states: what ``medallion.gold_daily`` gives for the same hours."""
    return state_rows.select(
        *DAY,
        avg_exact_price(F.col("total"), F.col("priced")).alias("avg_price"),
        to_cents(F.col("low")).alias("min_price"),
        to_cents(F.col("high")).alias("max_price"),
        F.col("negative").cast("int").alias("negative_hours"),
        as_of.alias("updated_at"),
    )
