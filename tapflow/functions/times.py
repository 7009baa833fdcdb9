"""Naive local time. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: digits of a tap time, yyyyMMddHHmmss.
TAP_DIGITS = "^[0-9]{12}[0-5][0-9]$"


def tap_time(text: Column) -> Column:
    """``yyyyMMddHHmmss`` text or number to a naive timestamp, NULL if malformed."""
    digits = text.cast("string")

    def part(start: int, length: int) -> Column:
        return F.substring(digits, start, length).try_cast("int")

    made = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2), part(13, 2))
    return F.when(digits.rlike(TAP_DIGITS), made)


def tap_date(text: Column) -> Column:
    """``yyyyMMdd`` text or number to a date, NULL if malformed."""
    return F.try_to_timestamp(text.cast("string"), F.lit("yyyyMMdd")).cast("date")


def floor_time(ts: Column, unit: str) -> Column:
    """Truncate a naive timestamp to ``hour`` or ``second``."""
    zero = F.lit(0)
    minute = F.minute(ts) if unit == "second" else zero
    second = F.second(ts) if unit == "second" else zero
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), minute, second)


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds, as a double."""

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")

    return F.date_diff(F.to_date(end), F.to_date(start)) * F.lit(86400.0) + of_day(end) - of_day(start)


def hour_in(ts: Column, low: int, high: int) -> Column:
    """Hour of day within ``[low, high]``, both ends included."""
    return F.hour(ts).between(low, high)


def is_weekday(date: Column) -> Column:
    return F.weekday(date) < 5


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def hour_stamp(ts: Column) -> Column:
    """``yyyyMMddHH``."""
    return F.concat(F.date_format(F.to_date(ts), "yyyyMMdd"), F.lpad(F.hour(ts).cast("string"), 2, "0"))
