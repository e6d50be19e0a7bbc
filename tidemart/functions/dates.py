"""Epoch and calendar conversions.

Every function takes epoch milliseconds or columns holding them.  ``tz`` names the zone
the calendar is read in; without it the session zone (UTC in ``build_session``) applies.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DAY_KEY = "yyyyMMdd"
DAY_MS = 86_400_000


def at_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def at_seconds(s: Column) -> Column:
    return F.timestamp_seconds(s.cast("bigint"))


def _local(ts: Column, tz: str | None) -> Column:
    return F.from_utc_timestamp(ts, tz) if tz else ts


def format_millis(ms: Column, pattern: str, tz: str | None = None) -> Column:
    return F.date_format(_local(at_millis(ms), tz), pattern)


def to_date_text(ms: Column, tz: str | None = None) -> Column:
    return format_millis(ms, DATE, tz)


def to_datetime_text(ms: Column, tz: str | None = None) -> Column:
    return format_millis(ms, DATE_TIME, tz)


def local_day(ms: Column, tz: str | None = None) -> Column:
    """The calendar day as a date; cheaper to group by than its text."""
    return F.to_date(_local(at_millis(ms), tz))


def day_start_millis(day: Column, tz: str | None = None) -> Column:
    """Epoch milliseconds at which the given calendar day starts."""
    midnight = day.cast("timestamp")
    return F.unix_millis(F.to_utc_timestamp(midnight, tz) if tz else midnight)


def parse_datetime(text: Column, tz: str | None = None, pattern: str = DATE_TIME) -> Column:
    ts = F.to_timestamp(text, pattern)
    return F.unix_millis(F.to_utc_timestamp(ts, tz) if tz else ts)


def parse_date(text: Column, tz: str | None = None) -> Column:
    return parse_datetime(text, tz, DATE)


def from_epoch_days(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))
