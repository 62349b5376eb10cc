"""Kafka sinks for keyed messages and dead letters (needs the Kafka connector
on the classpath; without it, the JSON-lines and Parquet sinks are used)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """``(key, value)`` rows to a topic; the key keeps all revisions of one
    (region, hour) on one partition, in order."""
    (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_dead_letters(rejects: DataFrame, servers: str, topic: str) -> None:
    """Rejected messages with their reason as JSON values, keyed like the input."""
    value = F.to_json(F.struct("value", "reason", F.col("kafka_ts").cast("string").alias("received_at")))
    write_messages(rejects.select("key", value.alias("value")), servers, topic)
