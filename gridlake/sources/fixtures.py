"""Driver tables as inputs of the reference's shapes (see FIXTURES.md).

Each function reads only the columns it needs, so Parquet scans are pruned,
and derives the input as a plain projection that stays inside one
whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.money import cents_to_price
from gridlake.session import ensure_utc

# --- Fixed values of the fixture mapping (FIXTURES.md, part B) ---------------
# Query time of the fixture data (after its last event, 2024-01-30).
AS_OF = "2024-01-31 00:00:00"
# Earlier run used as the stored state that later runs merge into.
PREVIOUS_RUN = "2024-01-30 00:00:00"
# Price offset in cents so that some prices are negative.
PRICE_OFFSET_CENTS = 2000
OBSERVATION_SOURCE = "events"
# Broken messages sent besides the good ones, first match wins: (modulus, kind).
MESSAGE_RULES = (
    (19, "not_json"), (17, "null_price"), (23, "bad_delivery_ts"), (29, "bad_fetched_at"), (31, "huge_price"),
)
HUGE_PRICE = "1e300"
# Feeds: documents are grouped into feeds of one source and one id block. A feed is one
# cell, so the block bounds it: at most this many whole texts.
FEED_BLOCK = 100
# Region used where the reference dashboard filters one bidding zone.
DASHBOARD_REGION = "click"
# -----------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def price_cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint") - PRICE_OFFSET_CENTS


def _in_raw_range(events: DataFrame, since: Column | None, through: Column | None) -> DataFrame:
    """Bounds on the raw event time that bounds on the delivery hour imply: the hour is
    the event time truncated, so hour >= since needs ts >= since truncated up to an hour
    at most, and hour <= through needs ts < the hour after it. Literals, so the Parquet
    scan skips row groups by them."""
    if since is not None:
        events = events.where(F.col("ts") >= F.date_trunc("hour", since).cast("timestamp_ntz"))
    if through is not None:
        after = F.date_trunc("hour", through) + F.make_dt_interval(F.lit(0), F.lit(1))
        events = events.where(F.col("ts") < after.cast("timestamp_ntz"))
    return events


def observations(
    spark: SparkSession,
    sf_dir: str,
    batch: int | None = None,
    since: Column | None = None,
    through: Column | None = None,
    fetched_through: Column | None = None,
    price_scale: int = 100,
) -> DataFrame:
    """Price observations (bronze shape): one row per revision.

    ``batch`` 1 or 0 selects ``event_id % 2``, to replay the data as two loads. ``since``
    and ``through`` are bounds on the delivery hour that the caller applies as well;
    ``fetched_through`` keeps what an earlier run had seen. ``price_scale`` 1000 gives
    prices of a tenth of a cent.
    """
    events = _in_raw_range(read_table(spark, sf_dir, "events"), since, through)
    if fetched_through is not None:
        events = events.where(F.col("ts") <= fetched_through.cast("timestamp_ntz"))
    if batch is not None:
        events = events.where(F.col("event_id") % 2 == batch)
    fetched = F.col("ts").cast("timestamp")
    cents = price_cents(F.col("value"))
    price = cents_to_price(cents) if price_scale == 100 else cents.cast("double") / float(price_scale)
    return events.select(
        F.col("event_type").alias("region"),
        F.date_trunc("hour", fetched).alias("delivery_ts"),
        price.alias("price_eur_mwh"),
        F.lit(OBSERVATION_SOURCE).alias("source"),
        fetched.alias("fetched_at"),
    )


def events_for_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


# --- News fixture (FIXTURES.md, "news <- documents, labels, pages") -----------
# Publication time: 2024-01-01 plus (doc_id % 720) hours.
NEWS_EPOCH = "2024-01-01 00:00:00"
NEWS_HOURS = 720
# Classifier answers from labels: toxic -> "none of these", quality -> a topic.
LABEL_TOXIC = "none of these"
LABEL_QUALITY = "renewables"
LABEL_OTHER = "gas"
CONFIDENCE_QUALITY = 0.9
CONFIDENCE_OTHER = 0.6
MODEL = "labels-v1"
# In the second run the classifier gives no answer for doc_id % 3 = 0.
OUTAGE_MODULUS = 3
BROKEN_FEED_HOST = "broken.example"
# -----------------------------------------------------------------------------


def doc_link(source: Column, doc_id: Column) -> Column:
    return F.concat(F.lit("https://"), source, F.lit("/"), doc_id.cast("string"))


def published_ts(doc_id: Column) -> Column:
    return F.to_timestamp(F.lit(NEWS_EPOCH)) + F.make_dt_interval(F.lit(0), (doc_id % NEWS_HOURS).cast("int"))


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds built from documents (a title is the whole text), plus one truncated
    copy per feed block that no XML parser accepts."""
    from gridlake.sources.feeds import block_of, feed_url, render_feeds

    docs = documents(spark, sf_dir)
    ts = published_ts(F.col("doc_id"))
    items = docs.select(
        "source",
        F.col("doc_id").alias("item_id"),
        F.col("text").alias("title"),
        doc_link(F.col("source"), F.col("doc_id")).alias("link"),
        F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss Z").alias("rss_date"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("atom_date"),
    )
    # The copy is of the block's first feed by URL and text, found without the texts: without a
    # block there are no URLs, and the texts are titles without items.
    heads = docs.select("source", block_of("doc_id", FEED_BLOCK).alias("block"))
    url = feed_url(F.col("source"), F.col("block"))
    order = F.struct(url.alias("url"), F.concat("source", F.lit("</title></feed>")).alias("text"), "source")
    first = heads.groupBy("block").agg(F.min(order).alias("f")).select("f.source", "block")
    feeds = render_feeds(items, FEED_BLOCK, first)
    whole = F.struct("url", "xml")
    broken = F.struct(
        feed_url(F.lit(BROKEN_FEED_HOST), F.col("block")).alias("url"),
        F.expr("substring(xml, 1, length(xml) div 2)").alias("xml"),
    )
    return feeds.select(F.inline(F.when(F.col("marked"), F.array(whole, broken)).otherwise(F.array(whole))))


def classifier_answers(spark: SparkSession, sf_dir: str, outage: bool = False) -> DataFrame:
    """Classifier answers keyed by (source, link), from ``labels``.

    ``outage``: the second run's classifier gives no answer for some ids.
    """
    docs = documents(spark, sf_dir).select("doc_id", "source")
    lab = labels(spark, sf_dir)
    joined = docs.join(lab, on="doc_id")
    if outage:
        joined = joined.where(F.col("doc_id") % OUTAGE_MODULUS != 0)
    label = (
        F.when(F.col("toxic") == 1, F.lit(LABEL_TOXIC))
        .when(F.col("quality") == 1, F.lit(LABEL_QUALITY))
        .otherwise(F.lit(LABEL_OTHER))
    )
    confidence = F.when(F.col("quality") == 1, F.lit(CONFIDENCE_QUALITY)).otherwise(F.lit(CONFIDENCE_OTHER))
    return joined.select(
        "source",
        doc_link(F.col("source"), F.col("doc_id")).alias("link"),
        label.alias("label"),
        confidence.alias("confidence"),
        F.lit(MODEL).alias("model"),
    )
