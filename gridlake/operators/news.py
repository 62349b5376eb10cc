"""Headline classification, news upserts and topic statistics.

The classifier's answers are a table keyed by (source, link), joined to the
headlines (a keyed left join instead of the reference's positional zip, so it
partitions like any other join). "none of these" keeps the model but clears
category and confidence; a missing answer (classifier outage) leaves all three
NULL; that is how the two cases are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.time import local_ts
from gridlake.operators.revisions import latest_revision, revision_merge
from gridlake.schemas import NEWS_KEYS, NONE_LABEL

NEWS_COLUMNS = ["source", "link", "title", "published_ts", "category", "confidence", "model", "fetched_at"]


def classify(headlines: DataFrame, answers: DataFrame | None, fetched_at: Column) -> DataFrame:
    """Headlines ``(source, link, title, published_ts)`` plus classifier
    ``answers (source, link, label, confidence, model)`` -> news rows."""
    if answers is None:
        joined = headlines.select(
            "*",
            F.lit(None).cast("string").alias("label"),
            F.lit(None).cast("double").alias("confidence"),
            F.lit(None).cast("string").alias("model"),
        )
    else:
        joined = headlines.join(
            answers.select(*NEWS_KEYS, "label", "confidence", "model"), on=list(NEWS_KEYS), how="left"
        )
    unrelated = F.col("label").isNull() | (F.col("label") == NONE_LABEL)
    return joined.select(
        "source",
        "link",
        "title",
        "published_ts",
        F.when(~unrelated, F.col("label")).alias("category"),
        F.when(~unrelated, F.col("confidence").cast("double")).alias("confidence"),
        F.col("model"),
        fetched_at.alias("fetched_at"),
    )


def head(news: DataFrame, limit: int = 0) -> DataFrame:
    """First ``limit`` headlines in (source, pos) order; 0 keeps all."""
    if not limit:
        return news
    return news.orderBy("source", "url", "pos").limit(limit)


def latest_news(news: DataFrame) -> DataFrame:
    """Newest row per (source, link)."""
    return latest_revision(news.select(*NEWS_COLUMNS), NEWS_KEYS)


def merge_news(stored: DataFrame, batch: DataFrame, keep_label: bool = False) -> DataFrame:
    """Revision-aware news MERGE (newer ``fetched_at`` wins).

    ``keep_label``: an incoming row without a model (classifier outage) keeps
    the stored category, confidence and model instead of erasing them.
    """
    stored = stored.select(*NEWS_COLUMNS)
    batch = batch.select(*NEWS_COLUMNS)
    merged = revision_merge(stored, batch, NEWS_KEYS)
    if not keep_label:
        return merged
    old = stored.select(
        *NEWS_KEYS,
        F.col("category").alias("__c"),
        F.col("confidence").alias("__p"),
        F.col("model").alias("__m"),
        F.col("fetched_at").alias("__f"),
    )
    joined = merged.join(old, on=list(NEWS_KEYS), how="left")
    # Only rows replaced by an outage row take the stored label back.
    restore = F.col("model").isNull() & F.col("__m").isNotNull() & (F.col("fetched_at") > F.col("__f"))
    return joined.select(
        "source",
        "link",
        "title",
        "published_ts",
        F.when(restore, F.col("__c")).otherwise(F.col("category")).alias("category"),
        F.when(restore, F.col("__p")).otherwise(F.col("confidence")).alias("confidence"),
        F.when(restore, F.col("__m")).otherwise(F.col("model")).alias("model"),
        "fetched_at",
    )


def topic_counts(news: DataFrame) -> DataFrame:
    """Headlines per category, most first then by name; unclassified rows are
    not a category."""
    return (
        news.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("headlines"))
        .orderBy(F.col("headlines").desc(), "category")
    )


def ingest_counts(news: DataFrame) -> DataFrame:
    """Total, classified and other headlines (one row)."""
    total = F.count(F.lit(1))
    classified = F.count("category")
    return news.agg(total.alias("total"), classified.alias("classified"), (total - classified).alias("other"))


def news_by_day(news: DataFrame) -> DataFrame:
    """Classified headlines per (UTC day of publication, category)."""
    return (
        news.where(F.col("category").isNotNull())
        .groupBy(F.date_trunc("day", "published_ts").alias("day"), "category")
        .agg(F.count(F.lit(1)).alias("headlines"))
        .orderBy(F.col("day").desc(), F.col("headlines").desc())
    )


def price_days(gold: DataFrame, news: DataFrame) -> DataFrame:
    """Daily prices with the classified headlines published on that local day, one row
    per topic (a day without news has one row: no topic, 0 headlines). Both sides count
    days on the market's local calendar."""
    per_day = (
        news.where(F.col("category").isNotNull())
        .groupBy(F.to_date(local_ts("published_ts")).alias("local_day"), "category")
        .agg(F.count(F.lit(1)).alias("headlines"))
    )
    return gold.join(per_day, on="local_day", how="left").select(
        "region", "local_day", "avg_price", "negative_hours", "category", F.coalesce(F.col("headlines"), F.lit(0)).alias("headlines")
    )
