"""Landed JSON files of the price API: week chunks, chunk index, sample file.

Documents are read as text (one document per row, e.g. ``spark.read.text(path,
wholetext=True)`` over a folder of files) and decoded with ``from_json``;
rows are exploded on the executors. A chunk holds one region-week (at most 169
hours), so the per-document arrays are bounded; nothing is collected to the
driver.

Chunk rows are ``[epoch_ms, price]``. A NULL price means "not yet published"
and is skipped; a row that is not a pair or does not convert is skipped by
the chunk reader and raises in the strict sample reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.money import price_in_range
from gridlake.functions.time import iso_utc, week_start
from gridlake.sources.messages import message_body, message_key

CHUNK_SCHEMA = "meta_data map<string,string>, series array<array<string>>"
SAMPLE_SCHEMA = (
    "meta struct<source: string, filter: string, region: string, resolution: string, "
    "generated_at: string, hours: bigint>, series array<array<string>>"
)
# --- Fixed values -------------------------------------------------------------
# Landed chunk files keep the API's name: <filter>_<region>_hour_<week_start_ms>.json
CHUNK_FILE_PATTERN = r"([^/_]+)_([^/]+)_hour_(\d+)\.json$"
INDEX_SCHEMA = "timestamps array<bigint>"
EMPTY_INDEX = "chunk index is empty"
DEFAULT_REGION = "DE-LU"
NO_SERIES = "chunk payload has no 'series'"
BAD_SAMPLE_ROW = "malformed sample row"
SAMPLE_HOURS = 168
RESOLUTION = "hour"
HOUR_MS = 3_600_000
# Reasons why a chunk row is not a point; a NULL price (unpublished) is no fault.
NOT_A_PAIR = "not_a_pair"
BAD_TIME = "bad_time"
BAD_PRICE = "bad_price"
# -----------------------------------------------------------------------------


def _pair_text(ms: Column, price: Column) -> Column:
    return F.concat(F.lit("["), ms.cast("string"), F.lit(","), F.coalesce(price.cast("string"), F.lit("null")), F.lit("]"))


def _series_text(pairs: Column) -> Column:
    """JSON array text from an array of (ms, price) structs sorted by ms."""
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(pairs), lambda p: _pair_text(p["ms"], p["price"])), ","), F.lit("]"))


def week_chunk_documents(points: DataFrame, appended: str = "") -> DataFrame:
    """One JSON document per (region, local week) from price points, as the
    API serves them: after the published hours comes one unpublished hour (NULL),
    then the rows of ``appended`` as they are. Columns: region, week_start_ms, text.

    ``points`` must hold one row per (region, delivery_ts), as
    ``latest_revision`` returns; that bounds each collected array by the hours
    of one week (at most 169)."""
    ms = F.unix_millis("delivery_ts")
    grouped = points.groupBy("region", week_start("delivery_ts").alias("week_start")).agg(
        F.collect_list(F.struct(ms.alias("ms"), F.col("price_eur_mwh").alias("price"))).alias("pairs"),
        (F.max(ms) + HOUR_MS).alias("next_ms"),
    )
    after = F.concat(F.lit(",["), F.col("next_ms").cast("string"), F.lit(",null]" + ("," + appended if appended else "") + "]"))
    pairs = _series_text(F.col("pairs"))
    series = F.concat(F.substring(pairs, F.lit(1), F.length(pairs) - 1), after)
    meta = F.to_json(F.create_map(F.lit("region"), F.col("region"), F.lit("resolution"), F.lit(RESOLUTION)))
    return grouped.select(
        "region",
        F.unix_millis("week_start").alias("week_start_ms"),
        F.concat(F.lit('{"meta_data":'), meta, F.lit(',"series":'), series, F.lit("}")).alias("text"),
    )


def read_documents(spark, path: str) -> DataFrame:
    """Landed JSON documents, one row per file (pretty-printed files are
    fine): ``(file, text)``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def read_week_chunks(spark, path: str) -> DataFrame:
    """Landed chunk files -> ``(region, week_start_ms, text)``; region and
    week come from the file name, as in the API's URL."""
    docs = read_documents(spark, path)
    return docs.select(
        F.regexp_extract("file", CHUNK_FILE_PATTERN, 2).alias("region"),
        F.regexp_extract("file", CHUNK_FILE_PATTERN, 3).cast("bigint").alias("week_start_ms"),
        "text",
    )


def read_chunk_index(spark, path: str) -> DataFrame:
    """Index documents ``{"timestamps": [...]}`` -> one row per week start,
    sorted. An index without weeks raises (the reference fails the same way)."""
    doc = F.from_json(F.col("text"), INDEX_SCHEMA)
    weeks = F.col("d.timestamps")
    checked = F.when(F.coalesce(F.size(weeks), F.lit(0)) <= 0, F.raise_error(F.lit(EMPTY_INDEX))).otherwise(weeks)
    return (
        read_documents(spark, path)
        .select(doc.alias("d"))
        .select(F.explode(checked).alias("week_start_ms"))
        .orderBy("week_start_ms")
    )


def parse_week_chunks(chunks: DataFrame, region: str | None = None, strict_series: bool = True) -> DataFrame:
    """Chunk documents -> (region, delivery_ts, price_eur_mwh).

    Region: ``region`` if given, else the chunk row's ``region`` (the file
    name), else the document's ``meta_data.region``, else ``DE-LU``. A document without ``series`` raises (as the reference
    does) unless ``strict_series`` is off, then it yields nothing.
    """
    return _chunk_rows(chunks, region, strict_series).where("reason IS NULL AND price_eur_mwh IS NOT NULL").select(
        "region", "delivery_ts", "price_eur_mwh"
    )


def chunk_rejects(chunks: DataFrame, region: str | None = None) -> DataFrame:
    """Rows of chunk documents that are no points: region, row (as JSON), reason."""
    return _chunk_rows(chunks, region, True).where("reason IS NOT NULL").select(
        "region", F.to_json("row").alias("row"), "reason"
    )


def _chunk_rows(chunks: DataFrame, region: str | None, strict_series: bool) -> DataFrame:
    doc = F.from_json(F.col("text"), CHUNK_SCHEMA)
    own = F.col("region") if "region" in chunks.columns else F.lit(None).cast("string")
    parsed = chunks.select(own.alias("file_region"), doc.alias("d"))
    series = F.col("d.series")
    if strict_series:
        series = F.when(series.isNull(), F.raise_error(F.lit(NO_SERIES))).otherwise(series)
    reg = (
        F.lit(region)
        if region
        else F.coalesce(F.col("file_region"), F.col("d.meta_data")["region"], F.lit(DEFAULT_REGION))
    )
    rows = parsed.select(reg.alias("region"), F.explode(series).alias("row"))
    ms = _epoch_ms(F.try_element_at(F.col("row"), F.lit(1)))
    given = F.try_element_at(F.col("row"), F.lit(2))
    price = given.try_cast("double")
    reason = (
        F.when(F.coalesce(F.size("row"), F.lit(0)) != 2, NOT_A_PAIR)
        .when(ms.isNull(), BAD_TIME)
        .when(given.isNotNull() & ~F.coalesce(price_in_range(price), F.lit(False)), BAD_PRICE)
    )
    return rows.select(
        "region", "row", F.timestamp_millis(ms).alias("delivery_ts"), price.alias("price_eur_mwh"), reason.alias("reason")
    )


def _epoch_ms(text: Column) -> Column:
    """Epoch milliseconds from JSON number text; a float such as
    ``1788451200000.0`` is truncated to an integer, as ``int()`` does."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def chunk_index(chunks: DataFrame) -> DataFrame:
    """``{"timestamps": [...]}`` as rows: distinct week starts per region."""
    return chunks.select("region", "week_start_ms").distinct()


def latest_chunks(chunks: DataFrame, weeks: int = 1) -> DataFrame:
    """The newest ``weeks`` chunks of each region (top-N on the small index,
    then a semi-join back to the documents)."""
    rank = Window.partitionBy("region").orderBy(F.col("week_start_ms").desc())
    newest = (
        chunk_index(chunks).withColumn("__r", F.row_number().over(rank)).where(F.col("__r") <= weeks).drop("__r")
    )
    return chunks.join(newest, on=["region", "week_start_ms"], how="left_semi")


def sample_documents(points: DataFrame, as_of: Column, hours: int = SAMPLE_HOURS, source: str = "events") -> DataFrame:
    """Per region, the last ``hours`` published hours as one sample document
    ``{"meta": {...}, "series": [[ms, price], ...]}`` (bounded by ``hours``)."""
    newest_first = Window.partitionBy("region").orderBy(F.col("delivery_ts").desc())
    last = (
        points.where(F.col("delivery_ts") <= as_of)
        .withColumn("__r", F.row_number().over(newest_first))
        .where(F.col("__r") <= hours)
    )
    grouped = last.groupBy("region").agg(
        F.collect_list(F.struct(F.unix_millis("delivery_ts").alias("ms"), F.col("price_eur_mwh").alias("price"))).alias(
            "pairs"
        ),
        F.count(F.lit(1)).alias("hours"),
    )
    meta = F.to_json(
        F.struct(
            F.lit(source).alias("source"),
            F.lit(None).cast("string").alias("filter"),
            F.col("region").alias("region"),
            F.lit(RESOLUTION).alias("resolution"),
            iso_utc(as_of, micros=True).alias("generated_at"),
            F.col("hours").alias("hours"),
        )
    )
    return grouped.select(
        "region",
        "hours",
        F.concat(F.lit('{"meta":'), meta, F.lit(',"series":'), _series_text(F.col("pairs")), F.lit("}")).alias("text"),
    )


def parse_sample(samples: DataFrame, region: str | None = None) -> DataFrame:
    """Strict sample reader: NULL prices are skipped, any other bad row raises."""
    doc = F.from_json(F.col("text"), SAMPLE_SCHEMA)
    reg = F.lit(region) if region else F.coalesce(F.col("d.meta.region"), F.lit(DEFAULT_REGION))
    rows = samples.select(doc.alias("d")).select(reg.alias("region"), F.explode("d.series").alias("row"))
    ms_text = F.try_element_at(F.col("row"), F.lit(1))
    price_text = F.try_element_at(F.col("row"), F.lit(2))
    ms = ms_text.try_cast("bigint")
    price = price_text.try_cast("double")
    bad = (F.size("row") != 2) | ms.isNull() | (price_text.isNotNull() & price.isNull())
    checked = F.when(bad, F.raise_error(F.lit(BAD_SAMPLE_ROW))).otherwise(price)
    return rows.select("region", F.timestamp_millis(ms).alias("delivery_ts"), checked.alias("price_eur_mwh")).where(
        F.col("price_eur_mwh").isNotNull()
    )


def replay_lines(points: DataFrame, fetched_at: Column, source: str = "events") -> DataFrame:
    """Deterministic replay: messages in (delivery_ts, region) order. The
    sort is a range-partitioned global sort, so written part files are in
    replay order without a single-task bottleneck."""
    return points.select(
        "region",
        "delivery_ts",
        "price_eur_mwh",
        message_key(F.col("region"), F.col("delivery_ts")).alias("key"),
        message_body(F.col("region"), F.col("delivery_ts"), F.col("price_eur_mwh"), F.lit(source), fetched_at).alias(
            "value"
        ),
    ).orderBy("delivery_ts", "region")
