"""Delays per stop: implausible zeros, report histories, boxplot figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.functions import days, text
from punctua.functions.days import operating_day as day
from punctua.operators import quantiles
from punctua.operators.bundles import if_small
from punctua.operators.listing import order, sort
from punctua.operators.segments import clustering

# Whisker length in box heights, and the delay a boxplot leaves out from.
WHISKER = 1.5
OUTLIER_MINUTES = 30.0


def flat_zero_journeys(
    stop_events: DataFrame,
    as_of: str | days.Day,
    window: int = 28,
    line_like: str | None = None,
    min_days: int = 3,
    strict_zero: bool = False,
) -> DataFrame:
    """Journeys whose mean delay was exactly zero on more than ``min_days`` days.

    The mean lets +1 and -1 cancel; ``strict_zero`` asks for zeros only.
    """
    zero = F.max(F.abs("dep_delay")) == 0 if strict_zero else F.avg("dep_delay") == 0
    chosen = stop_events.where(F.col("dep_delay").isNotNull() & F.col("has_rt"))
    chosen = chosen.where(days.in_last_days(day(), as_of, window, strict=True))
    if line_like is not None:
        chosen = chosen.where(F.col("line_id").like(line_like))
    return (
        chosen.groupBy("operating_day", "line_id", "journey_no")
        .agg(zero.alias("flat"))
        .where("flat")
        .groupBy("line_id", "journey_no")
        .agg(F.min(day()).alias("first_day"), F.max(day()).alias("last_day"), F.count("*").alias("days"))
        .where(F.col("days") > min_days)
        .orderBy(*order("-days"))
    )


def reports_with_stops(
    reports: DataFrame,
    stop_events: DataFrame,
    line_short: str | None = None,
    ordered: bool = False,
    match_empty: bool = False,
) -> DataFrame:
    """Delay reports of stops that were not cancelled, beside the final stop events.

    Matched on day, line name, journey number and station name. A report that
    lacks one of them cannot match; such reports are spread by a hash so that
    they do not meet in one task. Other heavy keys are left to AQE.

    An empty text counts as lacking: ingest writes it for a missing number,
    and it would pair all unnumbered reports of a line at a station with all
    its unnumbered stops of the day. ``match_empty`` lets it match itself.
    ``ordered`` sorts the rows by day, line, journey, stop and report time.
    Tables clustered by journey are joined without a shuffle; their unnumbered
    rows are spread, so ``match_empty`` is not for them.
    """
    by = clustering(reports, stop_events)
    if by and match_empty:
        raise ValueError("tables clustered by journey cannot match rows without a number")
    chosen = reports.where(~F.col("stop_cancelled"))
    if line_short is not None:
        chosen = chosen.where(F.col("line_short") == line_short)
    keys = ["operating_day", "line_short", "journey_no", "station_name"]
    lacking = [F.col(k).isNull() for k in keys]
    if not match_empty:
        lacking += [F.col(k) == "" for k in keys[1:]]
    keyless = F.greatest(*[F.coalesce(c, F.lit(True)) for c in lacking])
    # odd, so never the 0 of the other side
    spread = F.xxhash64("station_no", "reported_at", "sched_dep", "journey_no").bitwiseOR(F.lit(1))
    left = chosen.withColumn("piece", F.when(keyless, spread).otherwise(F.lit(0)))
    right = stop_events.select(
        *by, *keys, "idx", "arr_delay", "dep_delay", F.lit(0).cast("bigint").alias("piece")
    )
    matched = left.join(right, [*by, *keys, "piece"], "left").select(
        "operating_day", "line_short", "line_id", "journey_no", "idx", "station_name",
        "sched_dep", "delay_arrival", "delay_departure", "reported_at",
        "arr_delay", "dep_delay",
    )
    keys = ("operating_day", "line_id", "journey_no", "idx", "reported_at")
    return sort(matched, *keys) if ordered else matched


def reports_with_station_names(
    reports: DataFrame, stations: DataFrame, ordered: bool = False
) -> DataFrame:
    """Delay reports with the name of their station.

    Numbers are compared as the texts delivered, so "0012" is not "12"; the
    result has them as integers. A station listed with several names or
    places repeats its reports (``stations.reports_with_names_of_day`` takes
    the name of the day). The list is broadcast if a count finds it
    small, as the reports are the largest table and busy stations its heavy keys.
    ``ordered`` sorts the rows by line, journey and report time.
    """
    names = stations.select(F.col("station_no").cast("string").alias("station_no"), "station_name")
    planned = reports.drop("station_name").where(F.col("sched_dep") != "")
    planned = planned.withColumn("station_no", F.col("station_no").cast("string"))
    named = planned.join(if_small(names), "station_no", "left")
    named = named.withColumn("station_no", F.col("station_no").try_cast("int"))
    return sort(named, "line_id", "journey_no", "reported_at") if ordered else named


def plausible_delays(
    stop_events: DataFrame,
    first: str | days.Day,
    last: str | days.Day,
    line_short: str | None = None,
    below: float = OUTLIER_MINUTES,
) -> DataFrame:
    """Stop events of a span with a departure delay below the cut."""
    chosen = stop_events.where(days.in_range(day(), first, last))
    chosen = chosen.where(F.col("dep_delay").isNotNull() & (F.col("dep_delay") < below))
    return chosen if line_short is None else chosen.where(F.col("line_short") == line_short)


def stop_labels(stop_events: DataFrame, which: str = "first") -> DataFrame:
    """First or last known station name per stop of a journey, with its axis label."""
    named = F.when(F.col("station_name").isNotNull(), F.struct("operating_day", "station_name"))
    pick = F.min(named) if which == "first" else F.max(named)
    return (
        stop_events.groupBy("line_short", "journey_no", "idx")
        .agg(pick["station_name"].alias("station_name"))
        .withColumn("label", text.indexed_stop_label(F.col("idx"), F.col("station_name")))
    )


def journey_days(stop_events: DataFrame) -> DataFrame:
    """On how many days a journey ran, and the first and last of them."""
    return stop_events.groupBy("line_short", "journey_no").agg(
        F.count_distinct("operating_day").alias("days"),
        F.min(day()).alias("first_day"),
        F.max(day()).alias("last_day"),
    )


def _value_counts(df: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Every distinct value of a group with its frequency, quartiles and fences.

    Frequencies are counted before the shuffle. Delays come in whole minutes,
    so what one task holds of a group is bounded by the range of delays and
    not by the number of rows.
    """
    group = Window.partitionBy(*keys)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    quartiles = F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).over(group)
    low, high = F.col("q")[0], F.col("q")[2]
    return (
        counted.withColumn("q", quartiles)
        .withColumn("low_fence", low - WHISKER * (high - low))
        .withColumn("high_fence", high + WHISKER * (high - low))
    )


def _inside() -> Column:
    return F.col("v").between(F.col("low_fence"), F.col("high_fence"))


def boxplot(
    df: DataFrame,
    keys: tuple[str, ...] = ("line_short", "journey_no", "idx"),
    value: str = "dep_delay",
    continuous: bool = False,
) -> DataFrame:
    """Median, quartiles, whisker ends and number of outliers per group.

    Whiskers end at the last value within 1.5 box heights, never inside the box.
    ``continuous`` is for values that seldom repeat, see ``quantiles``: the same
    figures, at three passes instead of one, and no task holds a whole group.
    """
    if continuous:
        return quantiles.boxplot(df, keys, value, WHISKER)
    inside = F.when(_inside(), F.col("v"))
    return (
        _value_counts(df, keys, value)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.min("q").alias("q"),
            F.min(inside).alias("low"),
            F.max(inside).alias("high"),
            F.sum(F.when(_inside(), 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            *keys,
            "n",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            F.least(F.col("low"), F.col("q")[0]).alias("whisker_low"),
            F.greatest(F.col("high"), F.col("q")[2]).alias("whisker_high"),
            "outliers",
        )
    )


def boxplot_outliers(
    df: DataFrame,
    keys: tuple[str, ...] = ("line_short", "journey_no", "idx"),
    value: str = "dep_delay",
    continuous: bool = False,
) -> DataFrame:
    """Values beyond the fences, each with its frequency; ``continuous`` as in ``boxplot``."""
    if continuous:
        return quantiles.outliers(df, keys, value, WHISKER)
    return (
        _value_counts(df, keys, value)
        .where(~_inside())
        .select(*keys, F.col("v").alias(value), "n")
    )
