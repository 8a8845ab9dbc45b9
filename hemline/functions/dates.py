"""Dates and instants without dependence on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemline.fixed_values import BUSINESS_OFFSET_HOURS, BUSINESS_ZONE
from hemline.functions.casts import as_column


def text_to_date(c: Column | str) -> Column:
    """Date part (first ten characters) of a timestamp text."""
    return F.substring(as_column(c), 1, 10).try_cast("date")


def compact_date(c: Column | str) -> Column:
    """'20250102' -> date; anything else NULL."""
    c = F.trim(as_column(c))
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(F.length(c) == 8, dashed.try_cast("date"))


# A time of day with its offset: without one, the instant would depend on the session's zone.
_WITH_OFFSET = r"\d\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|[+-]\d\d:?\d\d)$"


def _instant(c: Column | str) -> Column:
    """The instant of a text that states its offset; NULL for any other text."""
    c = F.trim(as_column(c))
    return F.when(c.rlike(_WITH_OFFSET), F.regexp_replace(c, r"([+-]\d\d)(\d\d)$", "$1:$2").try_cast("timestamp"))


def offset_text_to_date(c: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """Date, in ``zone``, of an instant written with its offset ('...T23:30:00.000+09:00');
    NULL without an offset.

    The shifted instant is cut to days by arithmetic: a cast to date would apply the
    session's zone once more.
    """
    local = F.from_utc_timestamp(_instant(c), zone)
    return F.date_from_unix_date(F.floor(F.unix_seconds(local) / 86400).cast("int"))


def utc_text_to_timestamp(c: Column | str) -> Column:
    """UTC wall-clock time of '2025-01-02T03:04:05Z' or of the same instant with another offset,
    as a zone-free timestamp; NULL without an offset."""
    # counted from the epoch: a cast of the instant would apply the session's zone
    seconds = (F.unix_micros(_instant(c)) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def business_date(ts: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Business date of a zone-free UTC timestamp."""
    return (as_column(ts) + F.make_interval(hours=F.lit(offset_hours))).cast("date")


def month_day(c: Column | str) -> Column:
    return F.date_format(as_column(c), "MM-dd")
