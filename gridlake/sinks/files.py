"""Line-oriented file sinks: replay files and classified-headline JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.time import iso_utc
from gridlake.sources.landed import replay_lines


def write_replay(points: DataFrame, path: str, fetched_at: Column) -> None:
    """Messages in (delivery_ts, region) order as text lines. The global sort
    is range-partitioned, so part files ``part-00000...`` hold consecutive
    slices: reading them in name order replays in order."""
    replay_lines(points, fetched_at).select("value").write.mode("overwrite").text(path)


def headline_lines(news: DataFrame) -> DataFrame:
    """One JSON object per classified headline (NULL fields kept as null)."""
    body = F.to_json(
        F.struct(
            "source",
            "link",
            "title",
            iso_utc(F.col("published_ts")).alias("published_ts"),
            "category",
            "confidence",
            "model",
        ),
        {"ignoreNullFields": "false"},
    )
    return news.select(body.alias("value"))


def write_headlines(news: DataFrame, path: str) -> None:
    headline_lines(news).write.mode("overwrite").text(path)
