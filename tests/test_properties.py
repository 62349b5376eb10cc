"""Property tests: JVM text and date handling equals Python's semantics."""

from __future__ import annotations

import datetime as dt
import email.utils
import html
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridlake.functions.text import clean_text, split_list, url_host
from gridlake.functions.time import parse_feed_date

_TAG = re.compile(r"<[^>]+>")
PIECES = [
    "<b>", "</b>", "<", ">", "&", "&amp;", "&lt;b&gt;", "&#246;", "&#x41;", "&nbsp;", "&copy", "&not", "&bogus;",
    " ", "  ", "\t", "\n", "\r\n", "\xa0", " ", "\x1c", "\x85", "​", "a", "Z", "é", "ß", "1", ";", "#",
]
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _python_clean(text):
    return re.sub(r"\s+", " ", html.unescape(_TAG.sub("", text))).strip()


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=60))
def test_clean_text_equals_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    assert got == {i: _python_clean(t) for i, t in enumerate(texts)}


_ZONES = st.sampled_from([0, 60, 120, -300, -240, 330, -600])


@SETTINGS
@given(
    st.lists(
        st.tuples(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2090, 1, 1)), _ZONES),
        min_size=1,
        max_size=40,
    )
)
def test_rfc2822_dates_equal_email_utils(spark, stamps):
    texts = []
    for naive, minutes in stamps:
        aware = naive.replace(microsecond=0, tzinfo=dt.timezone(dt.timedelta(minutes=minutes)))
        texts.append(email.utils.format_datetime(aware))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.ts for r in df.select("i", parse_feed_date("t").alias("ts")).collect()}
    want = {
        i: email.utils.parsedate_to_datetime(t).astimezone(dt.timezone.utc).replace(tzinfo=None)
        for i, t in enumerate(texts)
    }
    assert got == want


def test_named_zones_and_hosts(spark):
    df = spark.createDataFrame(
        [("Tue, 01 Sep 2026 08:00:00 EST", "https://user@h.example:8080/x?y#z"), ("1 Sep 2026 08:00 PDT", "no-scheme")],
        "t string, u string",
    )
    rows = df.select(parse_feed_date("t").alias("ts"), url_host("u").alias("h")).collect()
    assert rows[0].ts == dt.datetime(2026, 9, 1, 13, 0) and rows[0].h == "user@h.example:8080"
    assert rows[1].ts == dt.datetime(2026, 9, 1, 15, 0) and rows[1].h == "no-scheme"


def test_split_list(spark):
    row = spark.createDataFrame([(" a, b,,c ,",)], "s string").select(split_list("s").alias("l")).first()
    assert row.l == ["a", "b", "c"]


# --- revision merge equals a plain-Python MERGE ----------------------------------
_T0 = dt.datetime(2026, 1, 1)
_ROW = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.integers(0, 3),
    st.integers(-5, 5),
    st.sampled_from(["s1", "s2"]),
    st.one_of(st.none(), st.integers(0, 4)),
)


def _python_merge(stored, batch):
    """MERGE: newest incoming row per key (ties by price, source), update only
    when strictly newer, insert when unmatched; NULL keys/versions dropped."""
    incoming = {}
    for r in sorted(batch, key=lambda r: (r[2], r[3])):
        if r[0] is None or r[1] is None or r[4] is None:
            continue
        k = (r[0], r[1])
        if k not in incoming or r[4] > incoming[k][4]:
            incoming[k] = r
    out = {(r[0], r[1]): r for r in stored}
    for k, r in incoming.items():
        if k not in out or r[4] > out[k][4]:
            out[k] = r
    return out


def _as_rows(rows):
    return [(r, _T0 + dt.timedelta(hours=h), float(p), s, None if f is None else _T0 + dt.timedelta(hours=f))
            for r, h, p, s, f in rows]


@SETTINGS
@given(st.lists(st.lists(_ROW, max_size=25), min_size=1, max_size=4))
def test_revision_merge_equals_python_merge(spark, batches):
    from gridlake.operators.revisions import revision_merge
    from gridlake.schemas import BRONZE, KEYS

    state_py: dict = {}
    state = spark.createDataFrame([], BRONZE)
    for batch in batches:
        state_py = _python_merge(list(state_py.values()), batch)
        state = revision_merge(state, spark.createDataFrame(_as_rows(batch), BRONZE), KEYS)
    got = sorted(tuple(r) for r in state.collect())
    want = sorted(_as_rows(list(state_py.values())))
    assert got == want
