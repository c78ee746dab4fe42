"""Journeys without real time set against extra journeys of the same number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions import days, match
from punctua.functions.days import operating_day as day
from punctua.operators.listing import order
from punctua.operators.segments import clustering


def without_realtime(
    bundle_journeys: DataFrame,
    as_of: str | days.Day,
    window: int = 30,
    flag: str = "has_realtime",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct journeys that lacked real time by ``flag``."""
    by = (*clustering(bundle_journeys), *by)
    return (
        bundle_journeys.where(days.in_last_days(day(), as_of, window) & ~F.col(flag))
        .select(*by, "operating_day", "tier", "line_short", "journey_no", "has_realtime")
        .distinct()
    )


def extra_journeys(
    extras: DataFrame, as_of: str | days.Day, window: int = 30, pattern: str | None = None
) -> DataFrame:
    """Distinct extra journeys, of lines whose whole id matches ``pattern`` if given."""
    recent = extras.where(days.in_last_days(day(), as_of, window))
    if pattern is not None:
        recent = recent.where(match.full_match(F.col("line_id"), pattern))
    return recent.select(*clustering(extras), "operating_day", "line_short", "line_id", "journey_no", "operator").distinct()


def match_extras(missing: DataFrame, extras: DataFrame, null_safe: bool = False) -> DataFrame:
    """Every missing journey with the extra journeys of its day and number, if any.

    ``null_safe`` lets a missing number match a missing number, which is how
    a pandas merge treats keys.
    """
    right = extras.select(
        F.col("operating_day").alias("extra_day"),
        F.col("journey_no").alias("extra_no"),
        F.col("line_short").alias("extra_line_short"),
        F.col("line_id").alias("extra_line_id"),
        F.col("operator").alias("extra_operator"),
    )
    left_keys, right_keys = (day(), F.col("journey_no")), (F.col("extra_day"), F.col("extra_no"))
    if null_safe:
        on = [a.eqNullSafe(b) for a, b in zip(left_keys, right_keys)]
    else:
        on = [a == b for a, b in zip(left_keys, right_keys)]
    return missing.join(right, on, "left").drop("extra_day", "extra_no")


def only_matched(matched: DataFrame) -> DataFrame:
    """Missing journeys for which an extra journey with an operator ran."""
    return matched.where(F.col("extra_operator").isNotNull())


def missing_days_per_journey(
    missing: DataFrame, extras: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """First day, last day and number of matched rows per line and journey number.

    Counts the rows ``match_extras`` would give, fan-out included, without
    forming them: both sides are counted per day and number first, so the join
    meets at most one row of extras per key. Groups without a line or number
    drop out. Tables clustered by journey meet without a shuffle, and there a
    journey without a number ('') has no extras.
    """
    keys, near = [*by, "line_short", "journey_no"], clustering(missing, extras)
    left = (
        missing.where(F.col("line_short").isNotNull() & F.col("journey_no").isNotNull())
        .groupBy(*near, *keys, "operating_day")
        .agg(F.count("*").alias("rows"))
    )
    right = extras.groupBy(*near, "operating_day", "journey_no").agg(F.count("*").alias("matches"))
    return (
        left.join(right, [*near, "operating_day", "journey_no"], "left")
        .groupBy(*keys)
        .agg(
            F.min(day()).alias("first_day"),
            F.max(day()).alias("last_day"),
            F.sum(F.col("rows") * F.coalesce("matches", F.lit(1))).alias("days_missing"),
        )
        .orderBy(*order("-days_missing"))
    )
