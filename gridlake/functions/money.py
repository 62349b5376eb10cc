"""Exact price arithmetic in integer cents.

Prices are two-decimal amounts. Averages and percentages are rounded half away
from zero on the exact value (as SQL ``numeric`` does), computed from integer
sums so that every engine gives the same digits; ``round(double)`` does not
(half-cent ties land on either side depending on binary error).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake.functions.time import col


# --- Fixed value: numeric(10,2) holds less than this ---------------------------
PRICE_LIMIT = 99_999_999.995
# -----------------------------------------------------------------------------


def price_in_range(price: Column) -> Column:
    """Finite and representable as ``numeric(10,2)``."""
    return ~F.isnan(price) & (F.abs(price) < PRICE_LIMIT)


def exact(price: Column | str) -> Column:
    """A raw price as an exact decimal, for sums that don't depend on the order."""
    return col(price).cast("decimal(17,8)")


def avg_exact_price(total: Column, n: Column) -> Column:
    """Average of exact decimals (sum and count), rounded once to cents, half away
    from zero; NULL without a row."""
    num = (total * 100_000_000).cast("decimal(38,0)")
    den = (n * 1_000_000).cast("decimal(38,0)")
    magnitude = int_div(F.abs(num) * 2 + den, den * 2)
    signed = F.when(num < 0, -magnitude).otherwise(magnitude)
    return F.when(n > 0, signed.cast("double") / 100.0)


def to_cents(price: Column) -> Column:
    """An exact price rounded to cents (half away from zero), as a double."""
    return F.round(price, 2).cast("double")


def cents(price: Column | str) -> Column:
    """Price (double or decimal) to integer cents."""
    return F.round(col(price) * 100).cast("bigint")


def int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``div``), exact on bigint."""
    return F.call_function("div", a, b)


def rounded_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """numerator / denominator rounded half away from zero to ``scale`` digits,
    as a double; ``numerator`` is an integer already scaled by 10**scale.
    NULL when the denominator is 0 or NULL."""
    num = numerator.cast("bigint")
    den = denominator.cast("bigint")
    magnitude = int_div(F.abs(num) * 2 + den, den * 2)
    signed = F.when(num < 0, -magnitude).otherwise(magnitude)
    return F.when(den > 0, signed.cast("double") / float(10**scale))


def avg_price(sum_cents: Column, n: Column) -> Column:
    """Average price rounded to cents, from a sum of cents and a count."""
    return rounded_ratio(sum_cents, n, 2)


def avg_price_exact(sum_cents: Column, n: Column) -> Column:
    """Unrounded average: one correctly rounded division of two integers."""
    return F.when(n > 0, sum_cents.cast("double") / (n.cast("double") * 100.0))


def pct1(part: Column, total: Column) -> Column:
    """100 * part / total rounded half away from zero to one decimal."""
    return rounded_ratio(part.cast("bigint") * 1000, total, 1)


def cents_to_price(c: Column) -> Column:
    return c.cast("double") / 100.0


def money(c: Column) -> Column:
    """Serving's ``numeric(10,2)``."""
    return c.cast("decimal(10,2)")
