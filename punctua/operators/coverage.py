"""Coverage rates: how many journeys had real time.

All of these are plain grouped counts. Spark counts inside each scan task
first, so an operator, line or day with very many rows is reduced to one row
per task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from punctua.functions import days, incidents, match, numbers
from punctua.functions.days import operating_day as day
from punctua.operators.bundles import with_lines
from punctua.operators.listing import order, sort



def _counted(journeys: DataFrame, flag: str) -> list[Column]:
    """Totals of journeys, or of their daily counts (``daily_counts``), whose flags are numbers."""
    if isinstance(journeys.schema[flag].dataType, LongType):
        return [F.sum("total").alias("total"), F.sum(flag).alias("total_rt")]
    return [F.count("*").alias("total"), F.count_if(F.col(flag)).alias("total_rt")]


def daily_counts(journeys: DataFrame) -> DataFrame:
    """Journeys by day and line: what coverage by day, bundle, tier or line needs of them.

    Counts of several deliveries add up, so each delivery keeps its own, and a
    replaced delivery takes its counts along.
    """
    flags = (F.count_if(flag).alias(flag) for flag in ("has_realtime", "ever_reported"))
    return journeys.groupBy("operating_day", "line_id_short", "line_short").agg(F.count("*").alias("total"), *flags)


def operator_coverage(
    journeys: DataFrame, as_of: str | days.Day, recent: tuple[int, ...] = (1, 2, 3)
) -> DataFrame:
    """Journeys per operator, overall and for each of the last days, by size.

    Journeys without an operator form a group that counts zero.
    """
    operator, reported = F.col("operator"), F.col("ever_reported")
    counts = [
        F.count("operator").alias("total"),
        F.count(F.when(reported, operator)).alias("total_rt"),
    ]
    for back in recent:
        that_day = days.on_day(day(), as_of, back)
        counts.append(F.count(F.when(that_day, operator)).alias(f"day_{back}_total"))
        counts.append(F.count(F.when(that_day & reported, operator)).alias(f"day_{back}_rt"))
    table = journeys.groupBy("operator").agg(*counts)
    columns = [F.col("operator"), F.col("total"), F.col("total_rt")]
    for back in recent:
        whole, part = F.col(f"day_{back}_total"), F.col(f"day_{back}_rt")
        columns += [whole, part, numbers.percent(part, whole, 2).alias(f"day_{back}_percent")]
    return table.select(columns).orderBy(*order("-total"))


def line_coverage_on(journeys: DataFrame, lines: DataFrame, on: str | days.Day) -> DataFrame:
    """Percent with real time per line and bundle on one day."""
    return (
        with_lines(journeys.where(days.on_day(day(), on)), lines)
        .groupBy("line_id_short", "operating_day", "bundle")
        .agg(*_counted(journeys, "ever_reported"))
        .select(
            "line_id_short",
            "operating_day",
            "bundle",
            numbers.percent(F.col("total_rt"), F.col("total"), 1).alias("percent_rt"),
        )
    )


def bundle_coverage_by_day(
    journeys: DataFrame,
    lines: DataFrame,
    tiers: tuple[str, ...],
    as_of: str | days.Day,
    window: int = 60,
) -> DataFrame:
    """Percent with real time per day and bundle, for lines of the given tiers.

    ``journeys``: rows or their daily counts. The window leaves its first day out.
    """
    recent = journeys.where(days.in_last_days(day(), as_of, window, strict=True))
    return (
        with_lines(recent, lines.where(match.any_of(F.col("tier"), tiers)))
        .groupBy("operating_day", "bundle")
        .agg(*_counted(journeys, "ever_reported"))
        .select(
            days.day_text(day()).alias("day"),
            "bundle",
            numbers.percent(F.col("total_rt"), F.col("total"), 1).alias("percent_rt"),
        )
    )


def incidents_by_day(
    bundle_journeys: DataFrame,
    as_of: str | days.Day,
    window: int = 35,
    by: tuple[str, ...] = (),
    ordered: bool = True,
) -> DataFrame:
    """Daily coverage and incidents of the tier groups that have a report.

    ``bundle_journeys``: rows or their daily counts. ``by`` adds leading keys,
    such as the report bundle. ``ordered`` sorts the days; leave it off where another step follows.
    """
    keys = [*by, "operating_day", "tier_group"]
    rate = incidents.float_rate(F.col("total_rt"), F.col("total"))
    sheet = (
        bundle_journeys.where(days.in_last_days(day(), as_of, window))
        .withColumn("tier_group", incidents.tier_group(F.col("tier")))
        .where(F.col("tier_group").isin("ebene_1_2", "ebene_3"))
        .groupBy(*keys)
        .agg(*_counted(bundle_journeys, "ever_reported"))
        .withColumns({"total": F.col("total").cast("int"), "total_rt": F.col("total_rt").cast("int")})
        .withColumn("rate", rate)
        .withColumn("incidents", incidents.report_incidents(F.col("tier_group"), F.col("rate")))
    )
    return sort(sheet, *keys) if ordered else sheet


def contract_incidents_by_day(
    bundle_journeys: DataFrame, as_of: str | days.Day, window: int = 35, by: tuple[str, ...] = ()
) -> DataFrame:
    """Daily incidents in the contract form and in the virtual form with tier 3."""
    group, rate = F.col("tier_group"), F.col("rate")
    total, missing = F.col("total"), F.col("missing")
    return (
        bundle_journeys.where(days.in_last_days(day(), as_of, window))
        .withColumn("tier_group", incidents.tier_short(F.col("tier")))
        .groupBy(*by, "operating_day", "tier_group")
        .agg(*_counted(bundle_journeys, "ever_reported"))
        .withColumn("missing", F.col("total") - F.col("total_rt"))
        .withColumn("rate", numbers.ratio(F.col("total_rt"), F.col("total")))
        .withColumn("incidents", incidents.contract_incidents(group, rate, missing))
        .withColumn("virtual", incidents.virtual_incidents(group, rate, total, missing))
    )


def incomplete_journeys(
    bundle_journeys: DataFrame,
    as_of: str | days.Day,
    window: int = 21,
    tiers: tuple[str, ...] = ("1+", "1", "2"),
    dated_by: str = "has_realtime",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Journey numbers that lacked real time more than once.

    ``dated_by`` names the flag that dates the last delivery: the bundle
    reports count ``has_realtime`` but date by ``ever_reported``.
    """
    return (
        bundle_journeys.where(days.in_last_days(day(), as_of, window))
        .where(match.any_of(F.col("tier"), tiers))
        .groupBy(*by, "tier", "line_short", "journey_no")
        .agg(*_counted(bundle_journeys, "has_realtime"), F.max(F.when(F.col(dated_by), day())).alias("last_delivery"))
        .withColumn("missing", F.col("total") - F.col("total_rt"))
        .where(F.col("missing") > 1)
        .select(
            *by,
            "tier",
            "line_short",
            "journey_no",
            "total",
            "total_rt",
            "missing",
            numbers.round_scaled(numbers.ratio(F.col("total_rt"), F.col("total")), 2).alias("rate"),
            "last_delivery",
        )
        .orderBy(*order("-missing"))
    )


def missing_share(
    journeys: DataFrame,
    as_of: str | days.Day,
    window: int = 28,
    pattern: str | None = None,
    by_journey: bool = True,
) -> DataFrame:
    """Share of journeys without real time per line, or per line and journey number.

    ``pattern`` must match the whole line id. Groups missing once only drop out.
    """
    recent = journeys.where(days.in_last_days(day(), as_of, window))
    if pattern is not None:
        recent = recent.where(match.full_match(F.col("line_id"), pattern))
    keys = ["line_short", "journey_no"] if by_journey else ["line_short"]
    return (
        recent.groupBy(*keys)
        .agg(
            F.min(day()).alias("first_day"),
            F.max(day()).alias("last_day"),
            F.count("*").alias("total"),
            F.count_if(~F.col("has_realtime")).alias("missing"),
        )
        .where(F.col("missing") > 1)
        .withColumn("missing_share", numbers.ratio(F.col("missing"), F.col("total")))
        .orderBy(*order("-missing_share"))
    )


def line_coverage_by_day(
    bundle_journeys: DataFrame,
    first: str | days.Day,
    last: str | days.Day,
    flag: str = "has_realtime",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rate per day, tier and line over a span of days, with the last delivery.

    ``bundle_journeys``: rows or their daily counts.
    """
    return (
        bundle_journeys.where(days.in_range(day(), first, last))
        .groupBy(*by, "operating_day", "tier", "line_short", "line_id_short")
        .agg(
            *_counted(bundle_journeys, flag),
            F.max(F.when(F.col(flag).cast("boolean"), day())).alias("last_delivery"),
        )
        .withColumn(
            "rate", numbers.round_scaled(numbers.ratio(F.col("total_rt"), F.col("total")), 2)
        )
    )


def latest_day_per_client(journeys: DataFrame, as_of: str | days.Day, window: int = 7) -> DataFrame:
    """Last day each client reported on each line."""
    return (
        journeys.where(days.in_last_days(day(), as_of, window))
        .groupBy("line_id_short", "client_id")
        .agg(F.max(day()).alias("last_day"))
        .orderBy(*order("client_id", "line_id_short"))
    )


def journey_count(journeys: DataFrame) -> DataFrame:
    return journeys.agg(F.count("*").alias("total"))


def journey_span(journeys: DataFrame) -> DataFrame:
    """First day, last day and number of journeys held."""
    return journeys.agg(
        F.min(day()).alias("first_day"), F.max(day()).alias("last_day"), F.count("*").alias("total")
    )


def line_share(journeys: DataFrame, line_short: str | None = None) -> DataFrame:
    """Whole percent of a line's journeys with real time; all lines if none is given."""
    chosen = journeys if line_short is None else journeys.where(F.col("line_short") == line_short)
    return (
        chosen.groupBy("line_short")
        .agg(*_counted(chosen, "has_realtime"))
        .select(
            "line_short",
            F.rint(numbers.ratio(F.col("total_rt"), F.col("total")) * 100).alias("percent_rt"),
        )
    )
