"""Change-only emission of price points as a stateful stream.

State is the last seen price per natural key, kept by Structured Streaming
(checkpointed, so a restart does not re-emit everything). Points may be any time late:
there is no watermark, and a key's state stays until it is asked to expire. State grows by
one small row per region and hour ever seen; where that is too much, ``expire_days`` drops
a key that many days after it was last polled, and a later poll of it counts as new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

OUTPUT = "region string, delivery_ts timestamp, price_eur_mwh double, fetched_at timestamp"
STATE = "last_price double"


def _emit_changes_fn(expire_ms: int | None):
    # Nested so that the function travels to the Python workers by value.
    def emit(key, batches, state):
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames).sort_values(["fetched_at", "price_eur_mwh"], kind="stable")
        prices = rows["price_eur_mwh"]
        previous = prices.shift(1)
        if state.exists:
            previous.iloc[0] = state.get[0]
        first_ever = pd.Series(False, index=rows.index)
        if not state.exists:
            first_ever.iloc[0] = True
        # NULL-safe "differs from the previous revision".
        same = (prices == previous) | (prices.isna() & previous.isna())
        changed = rows[first_ever.to_numpy() | ~same.to_numpy()]
        last = prices.iloc[-1]
        state.update((None if pd.isna(last) else float(last),))
        if expire_ms is not None:
            state.setTimeoutDuration(expire_ms)
        if len(changed):
            yield changed[["region", "delivery_ts", "price_eur_mwh", "fetched_at"]]

    return emit


def changed_points(points: DataFrame, expire_days: float | None = None) -> DataFrame:
    """Streaming points ``(region, delivery_ts, price_eur_mwh, fetched_at)``
    -> only new or changed prices per (region, delivery_ts), in order of arrival."""
    return points.groupBy("region", "delivery_ts").applyInPandasWithState(
        _emit_changes_fn(None if expire_days is None else int(expire_days * 86_400_000)),
        OUTPUT,
        STATE,
        "append",
        GroupStateTimeout.NoTimeout if expire_days is None else GroupStateTimeout.ProcessingTimeTimeout,
    )
