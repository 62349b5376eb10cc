"""Time expressions: local wall clock, weekend, windows, due hour, formats.

Instants are ``timestamp`` values read in a UTC session (see ``session``).
Local wall-clock values are ``timestamp`` too, as in the lake schema; on the
fall-back day two instants share one local value, so keys stay on the instant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake.schemas import DUE_LOCAL_HOUR, LOCAL_TZ, TODAY_DUE_FROM_HOUR, ZONE_ABBREVIATION


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str | dt.datetime) -> Column:
    """An instant literal; strings are read as UTC (``2024-01-31 00:00:00``)."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.to_timestamp(F.lit(str(value)))


def local_ts(utc: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.from_utc_timestamp(col(utc), tz)


def to_utc(local: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.to_utc_timestamp(col(local), tz)


def is_weekend(local: Column | str) -> Column:
    """Saturday or Sunday on the local calendar (``dayofweek``: Sunday=1)."""
    return F.dayofweek(col(local)).isin(1, 7)


def hour_between(hour: Column | str, band: tuple[int, int]) -> Column:
    return col(hour).between(band[0], band[1])


def window_start(as_of: Column, since_hours: int, align_days: bool = True, tz: str = LOCAL_TZ) -> Column:
    """Start of the trailing recompute window.

    ``align_days`` floors the start to local midnight so a day leaving the
    window is never regrouped from a partial set of hours; ``False`` keeps the
    plain ``as_of - since_hours`` start.
    """
    start = as_of - F.make_dt_interval(F.lit(0), F.lit(since_hours))
    if not align_days:
        return start
    return to_utc(F.date_trunc("day", local_ts(start, tz)), tz)


def utc_offset_hours(utc: Column | str, tz: str = LOCAL_TZ) -> Column:
    return ((F.unix_seconds(local_ts(utc, tz)) - F.unix_seconds(col(utc))) / 3600).cast("int")


def zone_abbreviation(utc: Column | str, tz: str = LOCAL_TZ) -> Column:
    offset = utc_offset_hours(utc, tz)
    expr = F.lit(None).cast("string")
    for hours, name in ZONE_ABBREVIATION.items():
        expr = F.when(offset == hours, F.lit(name)).otherwise(expr)
    return expr


def local_text(utc: Column | str, pattern: str = "yyyy-MM-dd HH:mm", tz: str = LOCAL_TZ) -> Column:
    """``2024-01-31 01:00 CET``: local wall clock plus zone abbreviation."""
    return F.concat_ws(" ", F.date_format(local_ts(utc, tz), pattern), zone_abbreviation(utc, tz))


def due_through(now: Column, tz: str = LOCAL_TZ) -> Column:
    """Start of the last delivery hour that must be present (23:00 local).

    From 05:00 local every hour of today is due, before that only yesterday's.
    """
    local_now = local_ts(now, tz)
    today = F.to_date(local_now)
    day = F.when(F.hour(local_now) >= TODAY_DUE_FROM_HOUR, today).otherwise(F.date_sub(today, 1))
    local_due = F.make_timestamp(
        F.year(day), F.month(day), F.dayofmonth(day), F.lit(DUE_LOCAL_HOUR), F.lit(0), F.lit(0)
    )
    return to_utc(local_due, tz)


def iso_utc(c: Column | str, micros: bool = False) -> Column:
    """ISO-8601 text of an instant with a ``+00:00`` offset."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx" if micros else "yyyy-MM-dd'T'HH:mm:ssxxx"
    return F.date_format(col(c), pattern)


def week_start(utc: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Monday 00:00 local of the instant's week, as an instant."""
    return to_utc(F.date_trunc("week", local_ts(utc, tz)), tz)


def parse_instant(text: Column | str) -> Column:
    """Lenient ISO-8601 parse; NULL instead of an error on bad input."""
    return F.try_to_timestamp(col(text))


# --- Fixed values: RFC 2822 obsolete zone names and their offsets -------------
RFC2822_ZONES = {
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}
# -----------------------------------------------------------------------------


def parse_feed_date(text: Column | str) -> Column:
    """RFC-2822 (``Tue, 10 Sep 2026 08:00:00 +0200``, ``GMT``), then ISO-8601.

    The weekday is dropped first (``E`` cannot be parsed in Spark 3+); the
    result is an instant, or NULL when nothing matches.
    """
    raw = F.trim(col(text))
    no_day = F.regexp_replace(raw, r"^[A-Za-z]{3},\s*", "")
    # Named zones become numeric offsets; ``GMT``/``UT``/``Z`` mean UTC.
    named = F.regexp_replace(no_day, r"\s+(GMT|UT|UTC|Z)$", " +0000")
    for zone, offset in RFC2822_ZONES.items():
        named = F.regexp_replace(named, rf"\s+{zone}$", f" {offset}")
    single_digit_day = F.regexp_replace(named, r"^(\d)\s", "0$1 ")
    rfc = F.coalesce(
        F.try_to_timestamp(single_digit_day, F.lit("dd MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(single_digit_day, F.lit("dd MMM yyyy HH:mm Z")),
    )
    iso = F.try_to_timestamp(F.regexp_replace(raw, "Z$", "+00:00"))
    return F.when(raw == "", F.lit(None).cast("timestamp")).otherwise(F.coalesce(rfc, iso))
