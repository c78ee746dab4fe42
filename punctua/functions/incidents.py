"""Service tiers and contract incidents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tiers that share one target, and the targets of the contract.
TOP_TIERS = ("1+", "1", "2")
TARGET_12, SLACK_12 = 0.85, 0.05
TARGET_3, SLACK_3 = 0.75, 0.15


def tier_group(tier: Column) -> Column:
    """Report groups: tiers 1+, 1 and 2 together, tier 3, and all others."""
    return (
        F.when(tier.isin(*TOP_TIERS), F.lit("ebene_1_2"))
        .when(tier == "3", F.lit("ebene_3"))
        .otherwise(F.lit("andere"))
    )


def tier_short(tier: Column) -> Column:
    """'1_2' for tiers 1+, 1 and 2; any other tier keeps its name."""
    return F.when(tier.isin(*TOP_TIERS), F.lit("1_2")).otherwise(tier)


def float_rate(part: Column, whole: Column) -> Column:
    """Rate in 32-bit floats, as the incident report defines it."""
    return F.try_divide(part.cast("float"), whole.cast("float")).cast("float")


def report_incidents(group: Column, rate: Column) -> Column:
    """Incidents of the day sheet: tenths below 0.95, rounded half to even.

    No cap applies here. Each step stays a 32-bit float.
    """
    short = (F.lit(0.95).cast("float") - rate.cast("float")).cast("float")
    tenths = (short * F.lit(10.0).cast("float")).cast("float")
    below = rate.cast("float") < F.lit(TARGET_12).cast("float")
    counted = F.rint(tenths.cast("double")).cast("int")
    return F.when((group == "ebene_1_2") & below, counted).otherwise(F.lit(0))


def _tenths_below(rate: Column, slack: float) -> Column:
    return ((F.lit(1 - slack) - rate) * 10).cast("int")


def contract_incidents(group: Column, rate: Column, missing: Column) -> Column:
    """Contract form: tenths cut off, at most the journeys without real time."""
    capped = F.least(_tenths_below(rate, SLACK_12), missing)
    return F.when((group == "1_2") & (rate < TARGET_12), capped).otherwise(F.lit(0))


def virtual_incidents(group: Column, rate: Column, total: Column, missing: Column) -> Column:
    """As the contract form, and tier 3 as if it had a target, capped at all journeys."""
    tier_3 = F.least(_tenths_below(rate, SLACK_3), total)
    return (
        F.when(group == "1_2", contract_incidents(group, rate, missing))
        .when((group == "3") & (rate < TARGET_3), tier_3)
        .otherwise(F.lit(0))
    )
