"""Week chunks, chunk index, strict sample reader."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from gridlake.sources import landed as L

CHUNK = '{"meta_data":{"region":"DE-LU"},"series":[[1788451200000,155.15],[1788454800000,null],[1788458400000,-3.5],["x",1.0],[1788462000000,"abc"],[1788465600000],[1788469200000,"12.5"],[1788472800000.0,7.0]]}'


def docs(spark, texts, weeks=None):
    weeks = weeks or list(range(len(texts)))
    return spark.createDataFrame([("DE-LU", w, t) for w, t in zip(weeks, texts)], "region string, week_start_ms bigint, text string")


def test_null_and_malformed_rows_are_skipped(spark):
    pts = L.parse_week_chunks(docs(spark, [CHUNK])).orderBy("delivery_ts").collect()
    assert [(p.delivery_ts, p.price_eur_mwh) for p in pts] == [
        (dt.datetime(2026, 9, 3, 16, 0), 155.15),
        (dt.datetime(2026, 9, 3, 18, 0), -3.5),
        (dt.datetime(2026, 9, 3, 21, 0), 12.5),
        (dt.datetime(2026, 9, 3, 22, 0), 7.0),
    ]
    assert {p.region for p in pts} == {"DE-LU"}


def test_missing_series_raises(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        L.parse_week_chunks(docs(spark, ['{"meta_data":{}}'])).collect()
    assert L.parse_week_chunks(docs(spark, ['{"meta_data":{}}']), strict_series=False).count() == 0


def test_latest_chunks(spark):
    texts = [f'{{"series":[[{1788451200000 + w * 604800000},{w}.0]]}}' for w in range(4)]
    got = L.parse_week_chunks(L.latest_chunks(docs(spark, texts), weeks=2)).collect()
    assert sorted(p.price_eur_mwh for p in got) == [2.0, 3.0]


def test_sample_round_trip_and_strictness(spark):
    pts = spark.createDataFrame(
        [("DE-LU", dt.datetime(2026, 9, 3, 16 + h, 0), float(h) - 1.5) for h in range(5)],
        "region string, delivery_ts timestamp, price_eur_mwh double",
    )
    as_of = L.F.lit(dt.datetime(2026, 9, 3, 19, 0)).cast("timestamp")
    sample = L.sample_documents(pts, as_of, hours=3)
    assert sample.first().hours == 3
    back = L.parse_sample(sample).orderBy("delivery_ts").collect()
    assert [p.price_eur_mwh for p in back] == [-0.5, 0.5, 1.5]
    bad = spark.createDataFrame([('{"meta":{},"series":[[1,2.0],[3,"x"]]}',)], "text string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        L.parse_sample(bad).collect()
    nulls = spark.createDataFrame([('{"meta":{},"series":[[1,2.0],[3600000,null]]}',)], "text string")
    assert L.parse_sample(nulls).count() == 1


def test_replay_order_is_time_then_region(spark):
    pts = spark.createDataFrame(
        [("B", dt.datetime(2026, 1, 1, 1), 1.0), ("A", dt.datetime(2026, 1, 1, 1), 2.0), ("C", dt.datetime(2026, 1, 1, 0), 3.0)],
        "region string, delivery_ts timestamp, price_eur_mwh double",
    )
    lines = L.replay_lines(pts, L.F.lit(dt.datetime(2026, 1, 2)).cast("timestamp")).collect()
    assert [r.region for r in lines] == ["C", "A", "B"]
    assert len({r.key for r in lines}) == 3


def test_written_replay_files_are_in_order(spark, scratch):
    import glob
    import json

    from gridlake.sinks.files import write_replay

    pts = spark.createDataFrame(
        [(r, dt.datetime(2026, 1, 1) + dt.timedelta(hours=h), float(h)) for h in range(50) for r in ("B", "A")],
        "region string, delivery_ts timestamp, price_eur_mwh double",
    ).repartition(5)
    write_replay(pts, f"{scratch}/replay", L.F.lit(dt.datetime(2026, 1, 3)).cast("timestamp"))
    lines = []
    for part in sorted(glob.glob(f"{scratch}/replay/part-*")):
        lines += [json.loads(x) for x in open(part, encoding="utf-8").read().splitlines()]
    order = [(m["delivery_ts"], m["region"]) for m in lines]
    assert order == sorted(order) and len(order) == 100


def test_headline_lines_keep_nulls(spark):
    from gridlake.sinks.files import headline_lines

    news = spark.createDataFrame(
        [("s", "https://x/1", "T", None, None, None, "m")],
        "source string, link string, title string, published_ts timestamp, category string, confidence double, model string",
    )
    assert headline_lines(news).first().value == (
        '{"source":"s","link":"https://x/1","title":"T","published_ts":null,"category":null,"confidence":null,"model":"m"}'
    )


def test_landed_files_are_read_whole_with_names(spark, scratch):
    import json
    import os

    from pyspark.errors import PySparkException as _PSE

    os.makedirs(f"{scratch}/chunks")
    for week, region in ((1788451200000, "DE-LU"), (1789056000000, "DE-LU"), (1789056000000, "AT")):
        payload = {"meta_data": {}, "series": [[week, 10.0], [week + 3600000, None]]}
        with open(f"{scratch}/chunks/4169_{region}_hour_{week}.json", "w", encoding="utf-8") as fh:
            json.dump(payload, fh, indent=1)
    chunks = L.read_week_chunks(spark, f"{scratch}/chunks")
    assert sorted((r.region, r.week_start_ms) for r in chunks.select("region", "week_start_ms").collect()) == [
        ("AT", 1789056000000), ("DE-LU", 1788451200000), ("DE-LU", 1789056000000)]
    newest = L.parse_week_chunks(L.latest_chunks(chunks, 1)).collect()
    assert sorted((p.region, p.price_eur_mwh) for p in newest) == [("AT", 10.0), ("DE-LU", 10.0)]

    os.makedirs(f"{scratch}/index")
    with open(f"{scratch}/index/index_hour.json", "w", encoding="utf-8") as fh:
        json.dump({"timestamps": [1789056000000, 1788451200000]}, fh, indent=1)
    assert [r.week_start_ms for r in L.read_chunk_index(spark, f"{scratch}/index").collect()] == [
        1788451200000, 1789056000000]
    os.makedirs(f"{scratch}/empty")
    with open(f"{scratch}/empty/index_hour.json", "w", encoding="utf-8") as fh:
        json.dump({"timestamps": []}, fh)
    with pytest.raises((_PSE, Py4JJavaError)):
        L.read_chunk_index(spark, f"{scratch}/empty").collect()
