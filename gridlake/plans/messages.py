"""Message decode, reject routing and revision queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators.revisions import changed_rows, latest_revision, revision_merge
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.schemas import BRONZE, KEYS
from gridlake.sources import fixtures as X
from gridlake.sources import messages as MSG

_ISO_D = "strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_ISO_F = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_PRICE = f"CAST(CAST(round(value * 100) AS BIGINT) - {X.PRICE_OFFSET_CENTS} AS DOUBLE) / 100.0"
_KIND = (
    "CASE "
    + " ".join(f"WHEN event_id % {m} = 0 THEN '{k}'" for m, k in X.MESSAGE_RULES)
    + " END"
)
_MSG_CTE = (
    "msg",
    f"""SELECT event_id, ts, event_type AS region, {_PRICE} AS price,
       event_type || '|' || {_ISO_D} AS key, {_ISO_D} AS d_iso, {_ISO_F} AS f_iso, kind
    FROM (SELECT *, NULL AS kind FROM events
          UNION ALL SELECT * FROM (SELECT *, {_KIND} AS kind FROM events) k WHERE kind IS NOT NULL) e""",
)
_VALUE = """CASE kind
    WHEN 'not_json' THEN 'not json #' || CAST(event_id AS VARCHAR)
    WHEN 'null_price' THEN json_object('region', region, 'delivery_ts', d_iso, 'source', 'events', 'fetched_at', f_iso)::VARCHAR
    WHEN 'bad_delivery_ts' THEN json_object('region', region, 'delivery_ts', 'bad', 'price_eur_mwh', price, 'source', 'events', 'fetched_at', f_iso)::VARCHAR
    WHEN 'bad_fetched_at' THEN json_object('region', region, 'delivery_ts', d_iso, 'price_eur_mwh', price, 'source', 'events', 'fetched_at', 'bad')::VARCHAR
    WHEN 'huge_price' THEN '{"region":"' || region || '","delivery_ts":"' || d_iso || '","price_eur_mwh":' || HUGE ||
         ',"source":"events","fetched_at":"' || f_iso || '"}'
    ELSE json_object('region', region, 'delivery_ts', d_iso, 'price_eur_mwh', price, 'source', 'events', 'fetched_at', f_iso)::VARCHAR
  END"""
_REASON = f"""CASE kind WHEN 'not_json' THEN '{MSG.MALFORMED}' WHEN 'null_price' THEN '{MSG.MISSING.format("price_eur_mwh")}'
    WHEN 'bad_delivery_ts' THEN '{MSG.BAD_DELIVERY_TS}' WHEN 'bad_fetched_at' THEN '{MSG.BAD_FETCHED_AT}'
    WHEN 'huge_price' THEN '{MSG.PRICE_OUT_OF_RANGE}' END"""
_VALUE = _VALUE.replace("HUGE", f"'{X.HUGE_PRICE}'")


def _classified(spark, sf_dir):
    return MSG.classify(MSG.decode(MSG.fixture_messages(X.events_for_messages(spark, sf_dir))))


@query(
    "decoded_messages",
    S.with_(_MSG_CTE)
    + """SELECT key,
       CASE WHEN kind = 'not_json' THEN NULL ELSE region END AS region,
       CASE WHEN kind = 'not_json' THEN NULL WHEN kind = 'bad_delivery_ts' THEN 'bad' ELSE d_iso END AS delivery_ts,
       CASE WHEN kind IN ('not_json', 'null_price') THEN NULL WHEN kind = 'huge_price' THEN """
    + f"""CAST({X.HUGE_PRICE} AS DOUBLE) ELSE price END AS price_eur_mwh,
       CASE WHEN kind = 'not_json' THEN NULL ELSE 'events' END AS source,
       CASE WHEN kind = 'not_json' THEN NULL WHEN kind = 'bad_fetched_at' THEN 'bad' ELSE f_iso END AS fetched_at,
       ts AS kafka_ts
FROM msg""",
)
def decoded_messages(spark, sf_dir):
    """JSON value decoded with the declared schema and flattened."""
    decoded = MSG.decode(MSG.fixture_messages(X.events_for_messages(spark, sf_dir)))
    return decoded.select("key", *MSG.MESSAGE_FIELDS, "kafka_ts")


@query(
    "valid_messages",
    S.with_(_MSG_CTE)
    + """SELECT region, date_trunc('hour', ts) AS delivery_ts, price AS price_eur_mwh, 'events' AS source, ts AS fetched_at
FROM msg WHERE kind IS NULL""",
)
def valid_messages(spark, sf_dir):
    """Complete messages with parseable instants, bronze-shaped."""
    return MSG.valid_rows(_classified(spark, sf_dir))


@query(
    "dead_letters",
    S.with_(_MSG_CTE) + f"SELECT key, {_VALUE} AS value, {_REASON} AS reason, ts AS kafka_ts FROM msg WHERE kind IS NOT NULL",
)
def dead_letters(spark, sf_dir):
    """P5/K1: every other message, raw text kept, with its reason."""
    return MSG.rejected_rows(_classified(spark, sf_dir))


@query(
    "message_split_counts",
    S.with_(_MSG_CTE)
    + f"""SELECT coalesce({_REASON}, 'valid') AS outcome, count(*) AS messages FROM msg GROUP BY 1""",
)
def message_split_counts(spark, sf_dir):
    """Valid and rejected counts by reason (valid + rejected = input)."""
    return (
        _classified(spark, sf_dir)
        .groupBy(F.coalesce(F.col("reason"), F.lit("valid")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query(
    "message_envelope",
    S.with_(("obs", S.obs()), ("latest", S.latest()))
    + f"""SELECT region || '|' || strftime(delivery_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS key,
       json_object('region', region, 'delivery_ts', strftime(delivery_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00',
                   'price_eur_mwh', price_eur_mwh, 'source', 'events',
                   'fetched_at', strftime({S.AS_OF_SQL}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')::VARCHAR AS value
FROM latest""",
)
def message_envelope(spark, sf_dir):
    """Newest points as keyed messages published at ``as_of``."""
    points = latest_revision(state.bronze(spark, sf_dir), KEYS)
    return MSG.envelope(points, state.as_of())


_BRONZE_OUT = "region, delivery_ts, price_eur_mwh, source, fetched_at"


@query(
    "latest_revision",
    S.with_(("obs", S.obs()), ("latest", S.latest())) + f"SELECT {_BRONZE_OUT} FROM latest",
)
def latest_revision_q(spark, sf_dir):
    """Newest revision per (region, delivery hour)."""
    return latest_revision(state.bronze(spark, sf_dir), KEYS)


@query(
    "bronze_merge",
    S.with_(("obs", S.obs()), ("latest", S.latest())) + f"SELECT {_BRONZE_OUT} FROM latest",
)
def bronze_merge(spark, sf_dir):
    """Fold the odd batch, the even batch, then the odd batch again into
    bronze with the revision-aware MERGE; converges to the newest revisions."""
    odd = X.observations(spark, sf_dir, batch=1)
    even = X.observations(spark, sf_dir, batch=0)
    stored = latest_revision(odd, KEYS)
    stored = revision_merge(stored, even, KEYS)
    return revision_merge(stored, odd, KEYS)


# A point is polled again this long after it was first seen, at the same price.
_POLLED_AGAIN = "10 minutes"
# Hours of this region on the first day reach the stream last, weeks late; this other
# region's hours of that day are polled once more then, unchanged.
_LATE_REGION, _OLD_REGION, _FIRST_DAY, _LAST_POLL = "purchase", "click", "2024-01-02 00:00:00", "2024-02-01 00:00:00"
_POINTS_SQL = f"""obs AS (
    SELECT event_type AS region, date_trunc('hour', ts) AS delivery_ts, {_PRICE} AS price, ts AS fetched_at FROM events),
polled AS (SELECT * FROM obs UNION ALL SELECT region, delivery_ts, price, fetched_at + INTERVAL {_POLLED_AGAIN} FROM obs)"""
_CHANGED_TAIL = """,
lagged AS (
    SELECT *, lag(price) OVER (PARTITION BY region, delivery_ts ORDER BY fetched_at, price) AS prev,
           row_number() OVER (PARTITION BY region, delivery_ts ORDER BY fetched_at, price) AS rn
    FROM polled)
SELECT region, delivery_ts, price, fetched_at FROM lagged WHERE rn = 1 OR price IS DISTINCT FROM prev"""
_CHANGED_SQL = f"WITH {_POINTS_SQL}{_CHANGED_TAIL}"


def _price_points(spark, sf_dir):
    """Observations, each polled a second time at the same price."""
    events = X.read_table(spark, sf_dir, "events")
    fetched = F.col("ts").cast("timestamp")
    polls = F.array(fetched, fetched + F.expr(f"INTERVAL {_POLLED_AGAIN}"))
    return events.select(
        F.col("event_type").alias("region"),
        F.date_trunc("hour", fetched).alias("delivery_ts"),
        (X.price_cents(F.col("value")).cast("double") / 100.0).alias("price"),
        F.explode(polls).alias("fetched_at"),
    )


@query("changed_prices", _CHANGED_SQL)
def changed_prices(spark, sf_dir):
    """Emit an hour only when it is new or its price changed."""
    return changed_rows(_price_points(spark, sf_dir), KEYS, "price", "fetched_at", ["price"])


@query(
    "stream_bronze",
    S.with_(_MSG_CTE)
    + """, valid AS (SELECT region, date_trunc('hour', ts) AS delivery_ts, price AS price_eur_mwh, 'events' AS source,
                    ts AS fetched_at FROM msg WHERE kind IS NULL)
SELECT * FROM valid
QUALIFY row_number() OVER (PARTITION BY region, delivery_ts ORDER BY fetched_at DESC) = 1""",
)
def stream_bronze(spark, sf_dir):
    """S1/T1-T5 end to end: the bronze table that the ingest stream leaves."""
    from gridlake import lake as L

    lake = stream_lake(spark, sf_dir)
    return spark.read.parquet(lake.path(L.BRONZE)).select(*BRONZE.fieldNames())


def stream_lake(spark, sf_dir):
    """The fixture messages land as files (odd, then even events) in a fresh folder under
    the session's checkpoint folder; the ingest stream runs to completion (rejects routed,
    revision-aware merge). Returns its lake."""
    import uuid

    from gridlake import lake as L
    from gridlake.session import ensure_checkpoint_dir
    from gridlake.streaming.ingest import file_messages, start_ingest

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridlake-stream-{uuid.uuid4().hex}"
    events = X.events_for_messages(spark, sf_dir)
    for batch in (1, 0):
        MSG.fixture_messages(events.where(F.col("event_id") % 2 == batch)).write.json(f"{root}/inbox/batch={batch}")
    lake = L.Lake(f"{root}/lake")
    q = start_ingest(
        file_messages(spark, f"{root}/inbox/*", max_files_per_trigger=4), lake, f"{root}/checkpoint", {"availableNow": True}
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"ingest stream failed: {q.exception()}")
    return lake


# Split instant of the two landings of stream_changed_prices: mid-hour, so the
# revisions of some (region, hour) keys arrive in both runs.
STREAM_SPLIT = "2024-01-16 00:30:00"


@query("stream_changed_prices", _CHANGED_SQL)
def stream_changed_prices(spark, sf_dir):
    """Change-only emission with keyed state across restarts. The first half of
    the points lands, then the second half, then the hours held back (new keys, weeks
    late) with one more poll of other old hours at the price last seen; each time the
    stream restarts on the same checkpoint. The appended output equals the batch answer:
    the late keys are emitted, the unchanged poll is not."""
    import uuid

    from gridlake.functions.time import ts_literal
    from gridlake.session import ensure_checkpoint_dir
    from gridlake.streaming.changes import OUTPUT, changed_points

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridlake-changes-{uuid.uuid4().hex}"
    points = _price_points(spark, sf_dir).withColumnRenamed("price", "price_eur_mwh")
    split = ts_literal(STREAM_SPLIT)
    old = F.col("delivery_ts") < ts_literal(_FIRST_DAY)
    late = old & (F.col("region") == _LATE_REGION)
    newest = points.where(old & (F.col("region") == _OLD_REGION)).groupBy("region", "delivery_ts")
    newest = newest.agg(F.max_by("price_eur_mwh", F.struct("fetched_at", "price_eur_mwh")).alias("price_eur_mwh"))
    again = newest.withColumn("fetched_at", ts_literal(_LAST_POLL))
    landings = (
        points.where(~late & (F.col("fetched_at") < split)),
        points.where(~late & (F.col("fetched_at") >= split)),
        points.where(late).unionByName(again),
    )
    for part, rows in enumerate(landings, 1):
        rows.write.parquet(f"{root}/inbox/part={part}")
        stream = spark.readStream.schema(OUTPUT).parquet(f"{root}/inbox/part=*")
        q = (
            changed_points(stream)
            .writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"change stream failed: {q.exception()}")
    return spark.read.parquet(f"{root}/out").select(
        "region", "delivery_ts", F.col("price_eur_mwh").alias("price"), "fetched_at"
    )
