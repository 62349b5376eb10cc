"""Command line for the jobs: ``python -m gridlake <command> ...``.

Each command builds (or joins) a session and calls one job function; on a
cluster, submit ``gridlake/__main__.py`` with ``spark-submit`` and the same
arguments. All times are UTC instants (``2026-09-10T15:00:00``); ``--as-of``
defaults to now.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0).isoformat(sep=" ")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridlake", description=__doc__.splitlines()[0])
    p.add_argument("--lake", required=True, help="lake root folder (shared storage)")
    p.add_argument("--master", default=None, help="Spark master (set by spark-submit on a cluster)")
    sub = p.add_subparsers(dest="command", required=True)

    t = sub.add_parser("transform", help="bronze -> silver -> gold -> serving over a trailing window")
    t.add_argument("--as-of", default=None)
    t.add_argument("--since-hours", type=int, default=168)
    t.add_argument("--unaligned", action="store_true", help="plain as_of - since_hours window start")

    t.add_argument("--changed", action="store_true", help="the days that merges touched since the last such run, however old")

    b = sub.add_parser("backfill", help="landed week chunks -> bronze")
    b.add_argument("--chunks", required=True, help="folder of <filter>_<region>_hour_<ms>.json files")
    b.add_argument("--weeks", type=int, default=1)
    b.add_argument("--fetched-at", default=None)

    n = sub.add_parser("news", help="landed feed files + classifier answers -> news table")
    n.add_argument("--feeds", required=True, help="folder of feed documents (one file per feed)")
    n.add_argument("--answers", default=None, help="Parquet table (source, link, label, confidence, model)")
    n.add_argument("--keep-label", action="store_true")
    n.add_argument("--limit", type=int, default=0)
    n.add_argument("--fetched-at", default=None)

    m = sub.add_parser("maintain", help="compact small files, expire staged copies")
    m.add_argument("--min-input-files", type=int, default=5)
    m.add_argument("--older-than-days", type=int, default=7)
    m.add_argument("--retain-last", type=int, default=10)

    h = sub.add_parser("health", help="freshness check into pipeline_health")
    h.add_argument("--now", default=None)

    s = sub.add_parser("stream", help="messages -> rejects + bronze (Structured Streaming)")
    s.add_argument("--inbox", default=None, help="folder of JSON-lines envelopes (key, value, timestamp)")
    s.add_argument("--kafka-servers", default=None)
    s.add_argument("--topic", default=None)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default="30 seconds", help="processing-time interval, or 'available-now'")

    r = sub.add_parser("bi", help="print one BI statement over the serving tables as JSON lines")
    r.add_argument("statement", help="e.g. hour_profile, negative_totals, worst_days")
    r.add_argument("--region", default=None)

    v = sub.add_parser("view", help="answer a SQL statement over the stored serving tables as JSON lines")
    v.add_argument("statement", help="e.g. bi_hour_profile, dash_price_series")
    v.add_argument("--region", default=None)
    v.add_argument("--as-of", default=None, help="end of a panel's time range")

    rp = sub.add_parser("replay", help="sample files -> ordered message lines")
    rp.add_argument("--samples", required=True)
    rp.add_argument("--out", required=True)
    rp.add_argument("--fetched-at", default=None)
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    from gridlake import lake as L
    from gridlake.functions.time import ts_literal
    from gridlake.session import build_session

    spark = build_session(f"gridlake-{args.command}", master=args.master)
    lake = L.Lake(args.lake)
    result: object = None

    if args.command == "transform":
        from gridlake.jobs.transform import run_changed_days, run_transform

        if args.changed:
            result = run_changed_days(spark, lake, args.as_of or _now())
        else:
            result = run_transform(spark, lake, args.as_of or _now(), args.since_hours, align_days=not args.unaligned)
    elif args.command == "backfill":
        from gridlake.jobs.ingest import backfill
        from gridlake.sources.landed import read_week_chunks

        backfill(spark, lake, read_week_chunks(spark, args.chunks), args.fetched_at or _now(), weeks=args.weeks)
    elif args.command == "news":
        from pyspark.sql import functions as F

        from gridlake.jobs.ingest import ingest_news
        from gridlake.sources.landed import read_documents

        # A landed feed is named by its percent-encoded URL (the file path encodes it once more).
        name = F.regexp_extract("file", r"([^/]+?)(?:\.xml)?$", 1)
        url = F.url_decode(F.url_decode(name))
        feeds = read_documents(spark, args.feeds).select(url.alias("url"), F.col("text").alias("xml"))
        answers = spark.read.parquet(args.answers) if args.answers else None
        result = ingest_news(spark, lake, feeds, answers, args.fetched_at or _now(), args.keep_label, args.limit)
    elif args.command == "maintain":
        from gridlake.jobs.upkeep import maintain

        cutoff = dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=args.older_than_days)
        result = maintain(spark, lake, f"maintain-{_now().replace(' ', 'T').replace(':', '')}",
                          args.min_input_files, older_than=cutoff, retain_last=args.retain_last)
    elif args.command == "health":
        from gridlake.jobs.upkeep import check_freshness

        result = check_freshness(spark, lake, args.now or _now())
        if result["status"] != "ok":
            print(json.dumps(result))
            return 1
    elif args.command == "stream":
        from gridlake.streaming.ingest import file_messages, kafka_messages, start_ingest

        source = (
            kafka_messages(spark, args.kafka_servers, args.topic)
            if args.kafka_servers
            else file_messages(spark, args.inbox)
        )
        trigger = {"availableNow": True} if args.trigger == "available-now" else {"processingTime": args.trigger}
        start_ingest(source, lake, args.checkpoint, trigger, name="gridlake-ingest").awaitTermination()
    elif args.command == "bi":
        from gridlake.plans import bi

        fn = getattr(bi, args.statement)
        table = L.SERVING_DAILY if args.statement in ("negative_days", "worst_days") else L.SERVING_HOURLY
        frame = fn(bi.for_region(spark.read.parquet(lake.path(table)), args.region))
        for line in frame.toJSON().toLocalIterator():
            print(line)
    elif args.command == "view":
        from gridlake.plans import views

        views.register(spark, lake)
        for line in views.run(spark, args.statement, args.region, args.as_of or _now()).toJSON().toLocalIterator():
            print(line)
    elif args.command == "replay":
        from gridlake.sinks.files import write_replay
        from gridlake.sources.landed import parse_sample, read_documents

        write_replay(parse_sample(read_documents(spark, args.samples)), args.out, ts_literal(args.fetched_at or _now()))

    if result is not None:
        print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
