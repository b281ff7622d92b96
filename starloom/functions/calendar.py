"""Smart date and time keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(ts: Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """``HHmmss`` on the 24-hour clock as an integer; unique per second of the day."""
    return (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("int")


def time_key_half_day(ts: Column) -> Column:
    """``hhmmss`` on the 12-hour clock, kept for comparison with older extracts."""
    return F.date_format(ts, "hhmmss").cast("int")


def seconds_between(start: Column, stop: Column) -> Column:
    return F.unix_timestamp(stop) - F.unix_timestamp(start)
