"""Number, flag and ratio helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_null(text: Column) -> Column:
    """Text to double; empty or malformed text is NULL, never NaN or an error."""
    return text.try_cast("double")


def int_or_null(text: Column) -> Column:
    return text.try_cast("int")


def flag(text: Column) -> Column:
    """'true' in any case is true; everything else, also missing, is false."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def reported_flag(stamp: Column) -> Column:
    """True if a cancellation time was reported at all."""
    return F.coalesce(F.length(stamp) > 0, F.lit(False))


def cancelled_any(reported: Column, journey_cancelled: Column) -> Column:
    return F.coalesce(reported, F.lit(False)) | F.coalesce(journey_cancelled, F.lit(False))


def degrees(micro: Column) -> Column:
    """Integer micro-degrees (text or number) to degrees."""
    return micro.try_cast("bigint") / F.lit(1_000_000)


def ratio(part: Column, whole: Column) -> Column:
    """Float division; NULL instead of an error where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_scaled(value: Column, digits: int) -> Column:
    """Round the scaled double, as SQL engines on binary doubles do.

    Spark's own ``round`` goes through the decimal text and differs for
    values such as 23/40.
    """
    factor = F.lit(float(10**digits))
    return F.round(value * factor, 0) / factor


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_scaled(ratio(part, whole) * 100, digits)


def one_if_zero(value: Column) -> Column:
    return F.when(value == 0, F.lit(1)).otherwise(value)
