"""Dates, local times and day-window predicates.

Predicates compare the plain column with literals, so that they prune day
partitions and reach the Parquet reader.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date


def as_day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def operating_day() -> Column:
    return F.col("operating_day")


def day_of(value: Column) -> Column:
    """Operating day of ISO text with any offset: the local date as written."""
    return F.substring(value, 1, 10).try_cast("date")


def wall_time(value: Column) -> Column:
    """Local wall time of ISO text; the UTC offset at its end is dropped."""
    return F.substring(value, 1, 19).try_cast("timestamp_ntz")


def instant_to_local(instant: Column, zone: str = "Europe/Berlin") -> Column:
    """Wall time of an instant in ``zone``, whatever the session's zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_text(instant: Column, zone: str = "Europe/Berlin") -> Column:
    """The same as 'yyyy-MM-dd HH:mm:ss'; formatting would go through the session's zone."""
    return instant_to_local(instant, zone).cast("string")


def day_text(day: Column) -> Column:
    return day.cast("date").cast("string")


def second_of_day(stamp: Column) -> Column:
    return F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)


def in_last_days(day: Column, as_of: str | Day, days: int, strict: bool = False) -> Column:
    """From ``days`` before ``as_of`` to ``as_of``; ``strict`` leaves the first day out.

    Days loaded after ``as_of`` do not count, so a report of a past date stays as it was.
    """
    end = as_day(as_of)
    first = F.lit(end - dt.timedelta(days=days))
    return (day > first if strict else day >= first) & (day <= F.lit(end))


def on_day(day: Column, as_of: str | Day, days_back: int = 0) -> Column:
    return day == F.lit(as_day(as_of) - dt.timedelta(days=days_back))


def in_range(day: Column, first: str | Day, last: str | Day) -> Column:
    return day.between(F.lit(as_day(first)), F.lit(as_day(last)))


def previous_month(as_of: str | Day) -> tuple[Day, Day]:
    """First and last day of the calendar month before ``as_of``."""
    last = as_day(as_of).replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def in_previous_month(day: Column, as_of: str | Day) -> Column:
    return in_range(day, *previous_month(as_of))


def days_between(first: str | Day, last: str | Day) -> list[str]:
    """ISO texts of all days of a span, for explicit pivot columns."""
    start, end = as_day(first), as_day(last)
    return [(start + dt.timedelta(days=n)).isoformat() for n in range((end - start).days + 1)]


def last_days(as_of: str | Day, days: int) -> list[str]:
    end = as_day(as_of)
    return days_between(end - dt.timedelta(days=days), end)
