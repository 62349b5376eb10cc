"""Several streaming queries as one job."""

from __future__ import annotations

import time

import pytest

from gridlake.streaming.supervise import Progress, run_together


def _query(spark, scratch, name, body, trigger):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    writer = stream.writeStream.foreachBatch(body).queryName(name).option("checkpointLocation", f"{scratch}/{name}")
    return writer.trigger(**trigger).start()


def test_one_failing_query_ends_the_job_with_its_error(spark, scratch):
    def fail(batch, batch_id):
        raise ValueError("planted error")

    told = []
    listener = Progress(told.append)
    spark.streams.addListener(listener)
    try:
        every = {"processingTime": "300 milliseconds"}
        good = _query(spark, scratch, "good", lambda b, i: None, every)
        bad = _query(spark, scratch, "bad", fail, every)
        with pytest.raises(RuntimeError, match="(?s)stream bad failed.*planted error"):
            run_together(spark, [good, bad], timeout=120)
        assert not good.isActive and not bad.isActive
        for _ in range(50):
            if any("error" in t and t["query"] == "bad" for t in told):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert any("planted error" in (t.get("error") or "") for t in told if t["query"] == "bad")


def test_progress_rows_and_bounded_runs(spark, scratch):
    told = []
    listener = Progress(told.append)
    spark.range(12).write.parquet(f"{scratch}/in")
    spark.streams.addListener(listener)
    try:
        queries = []
        for name in ("one", "two"):
            stream = spark.readStream.schema("id long").parquet(f"{scratch}/in")
            w = stream.writeStream.foreachBatch(lambda b, i: b.count()).queryName(name).option("checkpointLocation", f"{scratch}/c-{name}")
            queries.append(w.trigger(availableNow=True).start())
        run_together(spark, queries, timeout=300, to_the_end=True)
        for _ in range(50):
            if {t["query"] for t in told if "error" in t} == {"one", "two"}:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = {t["query"]: t for t in told if "rows" in t and t["rows"]}
    assert rows["one"]["rows"] == rows["two"]["rows"] == 12 and rows["one"]["lag_ms"] >= 0
    assert all(t["error"] is None for t in told if "error" in t)
