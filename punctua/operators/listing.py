"""Sorted, distinct and first-n listings.

NULLs sort last in both directions, unlike Spark's default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order(*keys: str) -> list[Column]:
    """Sort columns; a leading '-' sorts that key downwards."""
    return [
        F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in keys
    ]


def sort(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*order(*keys))


def first_rows(df: DataFrame, n: int, *keys: str, skip: int = 0) -> DataFrame:
    """The ``n`` first rows in the given order, after ``skip`` rows."""
    ordered = sort(df, *keys)
    return (ordered.offset(skip) if skip else ordered).limit(n)


def sorted_distinct(df: DataFrame, *columns: str) -> DataFrame:
    return sort(df.select(*columns).distinct(), *columns)


def star_with(df: DataFrame, **extra: str | Column) -> DataFrame:
    """All columns, led by extra ones under names of their own."""
    return df.select(*[F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in extra.items()], "*")
