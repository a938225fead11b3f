"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column, pattern: str) -> Column:
    """Text to zone-less timestamp; unparsable text gives null."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def file_time(name: Column) -> Column:
    """Time held in a file name such as 2004.02.12.10.32.39: its first 14 digits."""
    return parse_time(F.substring(F.regexp_replace(name, r"\D", ""), 1, 14), "yyyyMMddHHmmss")


def month_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour units between two timestamps, floored (not calendar days)."""
    def clock(ts: Column) -> Column:
        return F.date_format(ts, "HH:mm:ss.SSSSSS")

    days = F.datediff(later, earlier)
    return F.when(clock(later) < clock(earlier), days - 1).otherwise(days)


def wraps_midnight(hour: Column, start: int, stop: int) -> Column:
    """Hour in [start, 24) or [0, stop)."""
    return (hour >= start) | (hour < stop)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
