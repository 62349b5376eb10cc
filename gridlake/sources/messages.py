"""Keyed JSON price messages: envelope, decode, validation, reject split.

A message is ``(key, value, timestamp)`` as a Kafka source delivers it, or as a
text/JSON file source does when no Kafka connector is present. Decoding and
validation are pure column expressions, so the same functions serve batch
replays and every micro-batch of the stream.

Law: every input row is either valid or rejected with exactly one reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlake.functions.money import price_in_range
from gridlake.functions.time import iso_utc, parse_instant
from gridlake.schemas import MESSAGE
from gridlake.sources import fixtures as X

CORRUPT = "_corrupt_record"
DECODE_SCHEMA = StructType([*MESSAGE.fields, StructField(CORRUPT, StringType())])
MESSAGE_FIELDS = [f.name for f in MESSAGE.fields]

# --- Fixed values: reject reasons, checked in this order ---------------------
MALFORMED = "malformed_json"
MISSING = "missing_{}"  # one per required field: region, delivery_ts, price_eur_mwh, fetched_at
NAN_PRICE = "nan_price"
PRICE_OUT_OF_RANGE = "price_out_of_range"  # infinite, or too large for numeric(10,2)
BAD_DELIVERY_TS = "bad_delivery_ts"
BAD_FETCHED_AT = "bad_fetched_at"
REQUIRED = ("region", "delivery_ts", "price_eur_mwh", "fetched_at")
# -----------------------------------------------------------------------------


def message_key(region: Column, delivery_ts: Column) -> Column:
    """Natural key text ``region|2024-01-01T00:00:00+00:00``."""
    return F.concat_ws("|", region, iso_utc(delivery_ts))


def message_body(region: Column, delivery_ts: Column, price: Column, source: Column, fetched_at: Column) -> Column:
    """Compact JSON body; NULL fields are left out, as a JSON encoder does."""
    return F.to_json(
        F.struct(
            region.alias("region"),
            iso_utc(delivery_ts).alias("delivery_ts"),
            price.alias("price_eur_mwh"),
            source.alias("source"),
            iso_utc(fetched_at, micros=True).alias("fetched_at"),
        )
    )


def envelope(points: DataFrame, fetched_at: Column, source: str = X.OBSERVATION_SOURCE) -> DataFrame:
    """Price points ``(region, delivery_ts, price_eur_mwh)`` as keyed messages
    stamped with one publish time."""
    return points.select(
        message_key(F.col("region"), F.col("delivery_ts")).alias("key"),
        message_body(F.col("region"), F.col("delivery_ts"), F.col("price_eur_mwh"), F.lit(source), fetched_at).alias(
            "value"
        ),
    )


def fixture_messages(events: DataFrame) -> DataFrame:
    """A good message per driver event, and a broken one besides for the events that
    ``MESSAGE_RULES`` picks (FIXTURES.md)."""
    fetched = F.col("ts").cast("timestamp")
    delivery = F.date_trunc("hour", fetched)
    price = X.price_cents(F.col("value")).cast("double") / 100.0
    region = F.col("event_type")
    kind = F.lit(None).cast("string")
    for modulus, name in reversed(X.MESSAGE_RULES):
        kind = F.when(F.col("event_id") % modulus == 0, F.lit(name)).otherwise(kind)
    good = message_body(region, delivery, price, F.lit(X.OBSERVATION_SOURCE), fetched)
    null_price = message_body(region, delivery, F.lit(None).cast("double"), F.lit(X.OBSERVATION_SOURCE), fetched)
    bad_delivery = F.to_json(
        F.struct(
            region.alias("region"),
            F.lit("bad").alias("delivery_ts"),
            price.alias("price_eur_mwh"),
            F.lit(X.OBSERVATION_SOURCE).alias("source"),
            iso_utc(fetched, micros=True).alias("fetched_at"),
        )
    )
    bad_fetched = F.to_json(
        F.struct(
            region.alias("region"),
            iso_utc(delivery).alias("delivery_ts"),
            price.alias("price_eur_mwh"),
            F.lit(X.OBSERVATION_SOURCE).alias("source"),
            F.lit("bad").alias("fetched_at"),
        )
    )
    huge_price = F.concat(
        F.lit('{"region":"'), region, F.lit('","delivery_ts":"'), iso_utc(delivery),
        F.lit(f'","price_eur_mwh":{X.HUGE_PRICE},"source":"{X.OBSERVATION_SOURCE}","fetched_at":"'),
        iso_utc(fetched, micros=True), F.lit('"}'),
    )
    value = (
        F.when(kind == "not_json", F.concat(F.lit("not json #"), F.col("event_id").cast("string")))
        .when(kind == "null_price", null_price)
        .when(kind == "bad_delivery_ts", bad_delivery)
        .when(kind == "bad_fetched_at", bad_fetched)
        .when(kind == "huge_price", huge_price)
    )
    return events.select(
        message_key(region, delivery).alias("key"),
        F.explode(F.array_compact(F.array(good, value))).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def decode(messages: DataFrame) -> DataFrame:
    """``from_json`` with the declared schema (PERMISSIVE: a bad document gives
    NULL fields and its text in ``_corrupt_record``); keeps key, raw value and
    transport time."""
    parsed = F.from_json(
        F.col("value").cast("string"), DECODE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    )
    # ``explode`` of a one-element array is a Generate node: later filters on
    # the parsed fields cannot be pushed below it, so each message is parsed
    # once instead of once per referenced field.
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.explode(F.array(parsed)).alias("d"),
        F.col("timestamp").alias("kafka_ts"),
    ).select("key", "value", "d.*", "kafka_ts")


def reject_reason(decoded: DataFrame) -> Column:
    """First failing check, or NULL for a valid message."""
    # Malformed: nothing could be read. A wrong-typed field leaves the others
    # parsed (and sets ``_corrupt_record``); it is reported as that field missing.
    nothing_parsed = F.coalesce(*[F.col(f).cast("string") for f in MESSAGE_FIELDS]).isNull()
    reason = F.when(F.col("value").isNull() | (F.col(CORRUPT).isNotNull() & nothing_parsed), F.lit(MALFORMED))
    for field in REQUIRED:
        reason = reason.when(F.col(field).isNull(), F.lit(MISSING.format(field)))
    return (
        reason.when(F.isnan(F.col("price_eur_mwh")), F.lit(NAN_PRICE))
        .when(~price_in_range(F.col("price_eur_mwh")), F.lit(PRICE_OUT_OF_RANGE))
        .when(parse_instant("delivery_ts").isNull(), F.lit(BAD_DELIVERY_TS))
        .when(parse_instant("fetched_at").isNull(), F.lit(BAD_FETCHED_AT))
    )


def classify(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("reason", reject_reason(decoded))


def valid_rows(classified: DataFrame) -> DataFrame:
    """Bronze-shaped rows of valid messages."""
    return classified.where(F.col("reason").isNull()).select(
        "region",
        parse_instant("delivery_ts").alias("delivery_ts"),
        "price_eur_mwh",
        "source",
        parse_instant("fetched_at").alias("fetched_at"),
    )


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Dead letters: the raw text as received, the reason, the transport time."""
    return classified.where(F.col("reason").isNotNull()).select("key", "value", "reason", "kafka_ts")
