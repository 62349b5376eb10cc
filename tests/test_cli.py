"""The command line drives the jobs end to end on a scratch lake."""

from __future__ import annotations

import json
import os

from gridlake import cli
from gridlake import lake as L


def test_backfill_transform_health_and_bi(spark, scratch, capsys):
    os.makedirs(f"{scratch}/chunks")
    hours = [[1704067200000 + h * 3600000, float(h % 7) - 2.0] for h in range(24 * 8)]
    with open(f"{scratch}/chunks/4169_DE-LU_hour_1704067200000.json", "w", encoding="utf-8") as fh:
        json.dump({"meta_data": {}, "series": hours}, fh, indent=1)
    lake = f"{scratch}/lake"
    assert cli.main(["--lake", lake, "backfill", "--chunks", f"{scratch}/chunks", "--fetched-at", "2024-01-09 00:00:00"]) == 0
    assert cli.main(["--lake", lake, "transform", "--as-of", "2024-01-09 00:00:00", "--since-hours", "400"]) == 0
    assert spark.read.parquet(L.Lake(lake).path(L.SERVING_HOURLY)).count() == 24 * 8
    assert cli.main(["--lake", lake, "health", "--now", "2024-01-08 12:00:00"]) == 0
    capsys.readouterr()
    assert cli.main(["--lake", lake, "bi", "negative_totals", "--region", "DE-LU"]) == 0
    row = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert row["total_hours"] == 24 * 8 and row["neg_hours"] > 0
    assert cli.main(["--lake", lake, "view", "bi_negative_totals", "--region", "DE-LU"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == row


def test_news_replay_and_maintain_commands(spark, scratch, capsys):
    os.makedirs(f"{scratch}/feeds")
    with open(f"{scratch}/feeds/a.xml", "w", encoding="utf-8") as fh:
        fh.write('<rss><channel><item><title>Wind &amp; sun</title><link>https://e/1</link>'
                 '<pubDate>Sat, 19 Sep 2026 08:00:00 +0000</pubDate></item></channel></rss>')
    lake = f"{scratch}/lake"
    assert cli.main(["--lake", lake, "news", "--feeds", f"{scratch}/feeds", "--fetched-at", "2026-09-20 00:00:00"]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"total": 1, "classified": 0, "other": 1}
    news = spark.read.parquet(L.Lake(lake).path(L.NEWS)).first()
    assert (news.title, news.category) == ("Wind & sun", None)

    os.makedirs(f"{scratch}/samples")
    with open(f"{scratch}/samples/latest.json", "w", encoding="utf-8") as fh:
        json.dump({"meta": {"region": "DE-LU"}, "series": [[1788454800000, 2.5], [1788451200000, 1.5], [1788458400000, None]]}, fh, indent=1)
    assert cli.main(["--lake", lake, "replay", "--samples", f"{scratch}/samples", "--out", f"{scratch}/replay",
                     "--fetched-at", "2026-09-10 00:00:00"]) == 0
    lines = [json.loads(r.value) for r in spark.read.text(f"{scratch}/replay").collect()]
    assert sorted(m["price_eur_mwh"] for m in lines) == [1.5, 2.5]

    assert cli.main(["--lake", lake, "maintain", "--min-input-files", "1", "--older-than-days", "0", "--retain-last", "1"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert "news_events" in out and spark.read.parquet(L.Lake(lake).path(L.NEWS)).count() == 1
