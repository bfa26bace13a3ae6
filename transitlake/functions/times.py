"""Time functions in UTC. They work on epoch microseconds, so the session zone has no effect."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_clock(ts: Column) -> Column:
    """The UTC wall clock of a timestamp, as a timestamp without zone."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def utc_text(ts: Column) -> Column:
    """UTC wall clock like ``2025-01-15 14:20:30.123456``; a fraction has no trailing zeros."""
    return utc_clock(ts).cast("string")


def utc_date(ts: Column) -> Column:
    """UTC calendar day of a timestamp as DATE."""
    return utc_clock(ts).cast("date")


def utc_hour(ts: Column) -> Column:
    """Start of the UTC hour, like ``2025-01-15T14:00:00Z``."""
    return F.concat(F.translate(F.substring(utc_text(ts), 1, 13), " ", "T"), F.lit(":00:00Z"))


def utc_stamp(ts: Column) -> Column:
    """UTC time with milliseconds cut, not rounded, like ``2025-01-15T14:20:30.123Z``."""
    # 23 characters hold the text up to the milliseconds; shorter text lacks trailing zeros.
    text = utc_text(ts)
    whole = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.concat(F.translate(F.rpad(F.substring(whole, 1, 23), 23, "0"), " ", "T"), F.lit("Z"))


def utc_iso(ts: Column) -> Column:
    """ISO text with offset: microseconds in six digits where there are any, like ``…:30.120000+00:00``."""
    text = F.translate(utc_text(ts), " ", "T")
    return F.concat(F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0")), F.lit("+00:00"))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as timestamp, NULL when it is not one. Text without an offset is UTC."""
    timed = F.regexp_replace(F.trim(text), r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00Z")
    zoned = F.regexp_replace(timed, r"(:\d{2}(?:\.\d+)?)$(?<![+-]\d{2}:\d{2})", "$1Z")
    # A time of day alone would be read as today.
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(zoned))


def previous_day(now: Column) -> Column:
    """UTC day before the one of ``now``: the day a daily run works on."""
    return F.date_sub(utc_date(now), 1)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microsecond resolution."""
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def seconds_since(ts: Column, now: Column) -> Column:
    """Seconds passed at ``now``, to one decimal; NULL when there is no timestamp."""
    return F.round(seconds_between(ts, now), 1)
