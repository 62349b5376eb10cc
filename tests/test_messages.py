"""Decode and reject routing: valid + rejected = input, one reason each."""

from __future__ import annotations

import datetime as dt

from gridlake.sources import fixtures as X
from gridlake.sources import messages as MSG
from tests.conftest import SF_MID

TS = dt.datetime(2026, 9, 7, 0, 0)


def envelopes(spark, values):
    return spark.createDataFrame([("k", v, TS) for v in values], "key string, value string, timestamp timestamp")


def test_split_is_complete_and_disjoint(spark):
    msgs = MSG.fixture_messages(X.events_for_messages(spark, SF_MID))
    classified = MSG.classify(MSG.decode(msgs))
    total = msgs.count()
    valid = MSG.valid_rows(classified).count()
    rejected = MSG.rejected_rows(classified).count()
    assert valid + rejected == total
    assert valid == 10_000  # every event's message; the broken ones come besides
    assert rejected == sum(any(i % m == 0 for m, _ in X.MESSAGE_RULES) for i in range(10_000))


def test_reasons(spark):
    good = '{"region":"DE-LU","delivery_ts":"2026-09-07T00:00:00+00:00","price_eur_mwh":-12.4,"source":"s","fetched_at":"2026-09-07T01:00:00+00:00"}'
    cases = {
        "not json": "malformed_json",
        good.replace('"region":"DE-LU",', ""): "missing_region",
        good.replace("-12.4", "null"): "missing_price_eur_mwh",
        good.replace("-12.4", '"12.5"'): "missing_price_eur_mwh",
        good.replace("-12.4", "NaN"): "nan_price",
        good.replace("-12.4", "Infinity"): "price_out_of_range",
        good.replace("-12.4", "-1e300"): "price_out_of_range",
        good.replace("-12.4", "100000000"): "price_out_of_range",
        good.replace("2026-09-07T00:00:00+00:00", "bad"): "bad_delivery_ts",
        good.replace("2026-09-07T01:00:00+00:00", "bad"): "bad_fetched_at",
        good.replace(',"source":"s"', ""): None,
        good: None,
    }
    classified = MSG.classify(MSG.decode(envelopes(spark, list(cases))))
    got = {r.value: r.reason for r in classified.select("value", "reason").collect()}
    assert got == cases
    valid = MSG.valid_rows(classified).collect()
    assert len(valid) == 2
    assert valid[0].delivery_ts == dt.datetime(2026, 9, 7, 0, 0)
    assert valid[0].price_eur_mwh == -12.4


def test_rejects_keep_the_raw_text(spark):
    classified = MSG.classify(MSG.decode(envelopes(spark, ["{broken"])))
    row = MSG.rejected_rows(classified).first()
    assert (row.value, row.reason) == ("{broken", "malformed_json")


def test_envelope_key_and_body(spark):
    pts = spark.createDataFrame([("DE-LU", TS, -12.4)], "region string, delivery_ts timestamp, price_eur_mwh double")
    row = MSG.envelope(pts, X.F.lit(TS).cast("timestamp")).first()
    assert row.key == "DE-LU|2026-09-07T00:00:00+00:00"
    assert row.value == (
        '{"region":"DE-LU","delivery_ts":"2026-09-07T00:00:00+00:00","price_eur_mwh":-12.4,'
        '"source":"events","fetched_at":"2026-09-07T00:00:00.000000+00:00"}'
    )
