"""Names and places of stations over time: intervals from observations, looked up as of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.operators.bundles import if_small
from punctua.operators.listing import sort

STATE = ("station_name", "lat", "lon")
RUN = 32


def station_intervals(observed: DataFrame, state: tuple[str, ...] = STATE) -> DataFrame:
    """(station_no, ``state``, valid_from, valid_until): what held of a station from one day to another.

    ``observed`` has a row for each time a station was called at, with its operating day, as stop
    events do. A day's state is the one seen most often on it, of equal ones the first in order;
    an interval lasts from the first day of a state to the day before another is seen. The first
    interval of a station has no start and the last no end (NULL), so every day lies in one.
    Rows without a number or day observe nothing. Numbers are compared as texts.

    Rows are counted by day in the scan tasks, so a task orders the days of a station, not its calls.
    """
    known = observed.where(F.col("station_no").isNotNull() & F.col("operating_day").isNotNull())
    seen = F.struct(*state)
    number = F.col("station_no").cast("string").alias("station_no")
    calls = known.select(number, "operating_day", seen.alias("state")).groupBy("station_no", "operating_day", "state")
    one = Window.partitionBy("station_no", "operating_day").orderBy(F.col("calls").desc(), "state")
    daily = calls.agg(F.count("*").alias("calls")).withColumn("place", F.row_number().over(one)).where("place = 1")
    along = Window.partitionBy("station_no").orderBy("operating_day")
    before = F.lag("state").over(along)
    # a state may be NULL in all columns, so the first day is told by its number
    starts = daily.withColumns({"first": F.row_number().over(along) == 1, "same": before.eqNullSafe(F.col("state"))})
    starts = starts.where(F.col("first") | ~F.col("same"))
    until = F.date_sub(F.lead("operating_day").over(along), 1)
    return starts.select(
        "station_no",
        *(F.col(f"state.{c}").alias(c) for c in state),
        F.when(~F.col("first"), F.col("operating_day")).alias("valid_from"),
        until.alias("valid_until"),
    )


def _histories(intervals: DataFrame) -> DataFrame:
    """One row a station: its names in order of time, in runs of ``RUN``, each led by its first day.

    Looking for a day passes the first days of the runs and then one run, not all intervals.
    """
    since = F.coalesce("valid_from", F.lit("0001-01-01").cast("date")).alias("since")
    place = F.row_number().over(Window.partitionBy("station_no").orderBy("since"))
    dated = intervals.select("station_no", since, F.col("station_name").alias("name"))
    runs = dated.withColumn("run", F.floor((place - 1) / RUN)).groupBy("station_no", "run")
    named = runs.agg(F.sort_array(F.collect_list(F.struct("since", "name"))).alias("names"))
    led = F.struct(F.col("names")[0]["since"].alias("since"), "names")
    return named.groupBy("station_no").agg(F.sort_array(F.collect_list(led)).alias("history"))


def reports_with_names_of_day(reports: DataFrame, intervals: DataFrame, ordered: bool = False) -> DataFrame:
    """Delay reports with the name their station had on the operating day; one row for each report.

    Like ``delays.reports_with_station_names``, which repeats a report for every name of its station.
    A report without a day, or of a station never observed, has no name. The intervals of a station are
    put in one row, in order, so the join is by number alone: broadcast if a count finds the list
    small, beyond that a sort-merge join in which AQE splits busy stations.
    """
    planned = reports.drop("station_name").where(F.col("sched_dep") != "")
    planned = planned.withColumn("station_no", F.col("station_no").cast("string"))
    day = F.col("operating_day")

    def upto(entries: Column) -> Column:
        return F.try_element_at(F.filter(entries, lambda entry: entry["since"] <= day), F.lit(-1))

    named = planned.join(if_small(_histories(intervals)), "station_no", "left")
    named = named.withColumn("station_name", upto(upto(F.col("history"))["names"])["name"]).drop("history")
    named = named.withColumn("station_no", F.col("station_no").try_cast("int"))
    return sort(named, "line_id", "journey_no", "reported_at") if ordered else named
