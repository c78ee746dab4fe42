"""Lists about delays from the day tables, each one job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions import days
from punctua.operators import delays, segments


def delay_lists(
    stop_events: DataFrame,
    reports: DataFrame | None,
    as_of: str | days.Day,
    window: int = 28,
) -> dict[str, DataFrame]:
    """Flat zeros, boxplot figures, segments and, given reports, these beside their stops.

    All of them cover the days from ``window`` before ``as_of`` to ``as_of``.
    """
    span = days.in_last_days(F.col("operating_day"), as_of, window)
    recent = stop_events.where(span)
    first = days.as_day(as_of) - dt.timedelta(days=window)
    lists = {
        "flat_zero": delays.flat_zero_journeys(recent, as_of, window),
        "boxplots": delays.boxplot(delays.plausible_delays(recent, first, as_of)),
        "repeated_stops": segments.repeated_stops(recent),
        "segments": segments.segments(recent),
    }
    if reports is not None:
        lists["reports_with_stops"] = delays.reports_with_stops(reports.where(span), recent)
    return lists


def write_lists(lists: dict[str, DataFrame], target: str) -> dict[str, str]:
    """Write each list below ``target``, replacing what is there, and return the paths."""
    paths = {name: f"{target.rstrip('/')}/{name}" for name in lists}
    for name, rows in lists.items():
        rows.write.mode("overwrite").parquet(paths[name])
    return paths
