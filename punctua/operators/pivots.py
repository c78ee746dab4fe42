"""Pivots and total rows of the reports.

Pivot columns are given, not discovered: days follow from the report's span,
bundles from its reader. That saves a pass over the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions.days import day_text
from punctua.operators.listing import order


def line_by_day(rates: DataFrame, day_columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Rates per tier and line (rows) and day (columns).

    The rates of several line ids that share a line name are added up, as the
    report does; ``weighted_line_by_day`` divides counts instead.
    """
    keys = [*by, "tier", "line_short"]
    return (
        rates.withColumn("day", day_text(F.col("operating_day")))
        .groupBy(*keys)
        .pivot("day", day_columns)
        .agg(F.sum("rate"))
        .orderBy(*order(*keys))
    )


def weighted_line_by_day(
    rates: DataFrame, day_columns: list[str], by: tuple[str, ...] = ()
) -> DataFrame:
    """As ``line_by_day``, with covered journeys divided by all journeys."""
    keys = [*by, "tier", "line_short"]
    return (
        rates.withColumn("day", day_text(F.col("operating_day")))
        .groupBy(*keys)
        .pivot("day", day_columns)
        .agg(F.try_divide(F.sum("total_rt").cast("double"), F.sum("total").cast("double")))
        .orderBy(*order(*keys))
    )


def day_by_bundle(rates: DataFrame, bundles: list[str]) -> DataFrame:
    """Percentages per day (rows) and the given bundles (columns), latest day first.

    For any number of bundles use the long form, ``coverage.bundle_coverage_by_day``.
    Two values for one day and bundle are an error, not a sum.
    """
    one = F.when(
        F.count(F.lit(1)) > 1,
        F.raise_error(F.lit("more than one value for a day and bundle")).cast("double"),
    ).otherwise(F.max("percent_rt"))
    return (
        rates.groupBy("day").pivot("bundle", bundles).agg(one).orderBy(*order("-day"))
    )


def with_total_row(table: DataFrame, keys: tuple[str, ...], summed: str, per: tuple[str, ...] = ()) -> DataFrame:
    """The table's rows and, per group of ``per``, one row with only the sum.

    Grouping sets read the table once; ``is_total`` marks the added rows.
    """
    others = [c for c in table.columns if c not in (*keys, *per, summed)]
    all_keys = [*per, *keys]
    return (
        table.groupingSets([all_keys, list(per)], *all_keys)
        .agg(
            *[F.when(F.grouping(keys[0]) == 0, F.max(c)).alias(c) for c in others],
            F.sum(summed).alias(summed),
            (F.grouping(keys[0]) == 1).alias("is_total"),
        )
    )
