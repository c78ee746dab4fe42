"""Exact quartiles of continuous values, by brackets that a sketch names and counting confirms.

Counting equal values, as ``delays.boxplot`` does, bounds what a task holds only while values
repeat. Here a mergeable sketch of each group names a narrow range around each quartile. One
further pass counts: rows outside the ranges add up to seven sums a group, values inside are kept.
The order statistics are then found by running sums, so a task sees about 1 in 500 of a large
group's values, and the result does not depend on how near the sketch came.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000  # the sketch errs by at most one rank in so many
MARGIN = 2  # half the width of a bracket, in such errors; one more is the sketch's own


def _join(left: DataFrame, groups: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Join one row a group to its rows; NULL keys are a group too.

    The rows stream past the groups of their task and are not sorted, so that memory follows the
    groups; AQE splits heavy keys of the larger side. It would not broadcast few groups by itself, as
    most of their partitions are empty, but sort the rows of a group in one task.
    """
    named = groups.select(*(F.col(k).alias(f"_key_{k}") for k in keys), *(c for c in groups.columns if c not in keys))
    same = reduce(Column.__and__, [left[k].eqNullSafe(named[f"_key_{k}"]) for k in keys])
    return left.join(named.hint("shuffle_hash"), same, how).drop(*(f"_key_{k}" for k in keys))


def _values(df: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    v = F.col(value).cast("double")
    # adding 0.0 makes -0.0 and 0.0 one value
    return df.select(*keys, (v + F.lit(0.0)).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))


def _brackets(values: DataFrame, keys: tuple[str, ...], accuracy: int) -> DataFrame:
    """Per group an array of six edges: below and above each quartile."""
    wide = MARGIN / accuracy
    shares = [q + side * wide for q in QUARTILES for side in (-1, 1)]
    edges = F.percentile_approx("v", shares, accuracy)
    return values.groupBy(*keys).agg(F.array_sort(edges).alias("edges"))


def _cells(values: DataFrame, brackets: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, low, high, n): a value inside a bracket is a cell of its own, the rest is seven cells."""
    v, edges = F.col("v"), F.col("edges")
    inside = reduce(Column.__or__, [v.between(edges[i], edges[i + 1]) for i in (0, 2, 4)])
    # overlapping brackets make some of the seven cells empty
    region = sum((F.when(v > edges[i], 1).otherwise(0) for i in range(6)), F.lit(0))
    placed = _join(values, brackets, keys).select(
        *keys, F.when(inside, v).alias("_exact"), F.when(~inside, region).alias("_region"), "v"
    )
    return (
        placed.groupBy(*keys, "_exact", "_region")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
        .drop("_exact", "_region")
    )


def _statistic(place: Column) -> Column:
    """The value at a place from 0, among cells with their running sum ``upto``.

    A cell of several values knows its first and last one only.
    """
    before = F.col("upto") - F.col("n")
    here = (before <= place) & (place < F.col("upto"))
    known = F.when((place == before) | (F.col("low") == F.col("high")), F.col("low"))
    known = known.when(place == F.col("upto") - 1, F.col("high"))
    lost = F.raise_error(F.lit("a quartile lies outside its bracket; raise the accuracy")).cast("double")
    return F.max(F.when(here, known.otherwise(lost)))


def quartiles(df: DataFrame, keys: tuple[str, ...], value: str, accuracy: int = ACCURACY) -> DataFrame:
    """(keys, n, q1, median, q3) of each group, interpolated between neighbours.

    NULL and NaN values are left out, and groups without others; a NULL key is a group.
    ``accuracy`` sizes the sketch and the brackets, not the result: larger groups may want a larger
    one, to hold fewer values a task.
    """
    values = _values(df, keys, value)
    cells = _cells(values, _brackets(values, keys, accuracy), keys)
    group = Window.partitionBy(*keys)
    running = group.orderBy("low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cells.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(group)})
    found = [F.max("total").alias("n")]
    for i, q in enumerate(QUARTILES):
        place = F.lit(q) * (F.col("total") - 1)
        found += [
            F.max(place - F.floor(place)).alias(f"part{i}"),
            _statistic(F.floor(place)).alias(f"at{i}"),
            _statistic(F.ceil(place)).alias(f"after{i}"),
        ]
    names = ("q1", "median", "q3")
    between = []
    for i, name in enumerate(names):
        at, after, part = F.col(f"at{i}"), F.col(f"after{i}"), F.col(f"part{i}")
        # equal neighbours first: an infinite one times 0 would be NaN
        between.append(F.when(at == after, at).otherwise(at * (1 - part) + after * part).alias(name))
    return summed.groupBy(*keys).agg(*found).select(*keys, "n", *between)


def _fenced(df: DataFrame, keys: tuple[str, ...], value: str, whisker: float, accuracy: int) -> DataFrame:
    """Every value beside its group's quartiles, and whether it lies within the fences."""
    box = quartiles(df, keys, value, accuracy)
    height = F.col("q3") - F.col("q1")
    inside = F.col("v").between(F.col("q1") - whisker * height, F.col("q3") + whisker * height)
    return _join(_values(df, keys, value), box, keys).withColumn("inside", inside)


def boxplot(
    df: DataFrame, keys: tuple[str, ...], value: str, whisker: float, accuracy: int = ACCURACY
) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per group, as in ``delays.boxplot``."""
    within = F.when(F.col("inside"), F.col("v"))
    return (
        _fenced(df, keys, value, whisker, accuracy)
        .groupBy(*keys)
        .agg(
            *(F.max(c).alias(c) for c in ("n", "q1", "median", "q3")),
            F.min(within).alias("low"),
            F.max(within).alias("high"),
            F.count_if(~F.col("inside")).alias("outliers"),
        )
        .select(
            *keys, "n", "q1", "median", "q3",
            F.least("low", "q1").alias("whisker_low"), F.greatest("high", "q3").alias("whisker_high"), "outliers",
        )
    )


def outliers(
    df: DataFrame, keys: tuple[str, ...], value: str, whisker: float, accuracy: int = ACCURACY
) -> DataFrame:
    """Values beyond the fences, each with its frequency."""
    apart = _fenced(df, keys, value, whisker, accuracy).where(~F.col("inside"))
    return apart.groupBy(*keys, F.col("v").alias(value)).agg(F.count("*").alias("n"))
