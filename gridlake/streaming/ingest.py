"""Structured Streaming ingest: messages -> rejects + bronze.

One streaming query reads the topic once. Each micro-batch is decoded and
classified once (persisted for the batch), rejects are written to
``rejected_messages/run_id=<checkpoint>/batch_id=<id>`` (overwritten on replay; another
checkpoint counts its batches in a folder of its own) and valid rows
are merged into bronze with the revision-aware merge, staged under the same
batch id. A batch replayed after a crash therefore converges to the same
tables: at-least-once delivery with idempotent effects. Late and out-of-order
revisions need no watermark: the merge orders them by ``fetched_at``.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake import lake as L
from gridlake.jobs.ingest import merge_bronze
from gridlake.session import ensure_utc
from gridlake.sources import messages as MSG

ENVELOPE = "key string, value string, timestamp timestamp"
DEFAULT_TRIGGER = "30 seconds"


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message envelopes from JSON-lines files landing in ``path`` (the
    stand-in for a Kafka topic when no Kafka connector is installed)."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", max_offsets: int | None = None
) -> DataFrame:
    """Message envelopes from a Kafka topic (needs the Kafka connector)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def process_batch(lake: L.Lake, run_id: str):
    """The ``foreachBatch`` callback for ``lake``; ``run_id`` names the checkpoint."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ensure_utc(spark)
        classified = MSG.classify(MSG.decode(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if classified.isEmpty():
                return
            rejects = MSG.rejected_rows(classified).withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id))})
            (
                rejects.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*L.REJECTS.partition_cols)
                .parquet(lake.path(L.REJECTS))
            )
            valid = L.with_delivery_date(MSG.valid_rows(classified))
            merge_bronze(spark, lake, valid, f"stream-{run_id}-{int(batch_id):012d}")
        finally:
            classified.unpersist()

    return handle


def start_ingest(
    messages: DataFrame,
    lake: L.Lake,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the ingest query. ``trigger`` is a ``DataStreamWriter.trigger``
    keyword set, e.g. ``{"processingTime": "30 seconds"}`` or
    ``{"availableNow": True}``."""
    spark = messages.sparkSession
    run_id = "run-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    writer = messages.writeStream.foreachBatch(process_batch(lake, run_id)).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"processingTime": DEFAULT_TRIGGER}))
    return writer.start()
