"""Payload values: exact decimals, UTC timestamps, canonical JSON, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(10,6)"
COUNT = "decimal(18,2)"


def dec(text: Column, dtype: str = PRICE, strict: bool = True) -> Column:
    """Decimal of a wire string; absent or empty is NULL, so no quote is not zero.

    A malformed value is an error under ANSI unless `strict` is off.
    """
    value = F.nullif(text.cast("string"), F.lit(""))
    return value.cast(dtype) if strict else value.try_cast(dtype)


def cents(dollars: Column) -> Column:
    return dollars * F.lit(100)


def ts(text: Column) -> Column:
    """RFC 3339 text to a timestamp; anything unreadable is NULL."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")))


def to_minute(moment: Column) -> Column:
    return F.date_trunc("minute", moment)


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no layout, so equal payloads compare equal."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """num/den as a double, NULL when the denominator is zero or NULL.

    Sums stay exact decimals up to this last division.
    """
    value = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)


def hours(n: float) -> Column:
    """A day-time interval of n hours (fractions kept to the second)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(round(n * 3600)).cast("decimal(18,6)"))


def present(col: Column) -> Column:
    """A usable text or numeric key: neither NULL nor empty."""
    return F.coalesce(F.length(col.cast("string")) > 0, F.lit(False))
