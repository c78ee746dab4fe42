"""Quartiles by brackets against numpy and Spark's own percentile."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctua.operators import delays, quantiles


def expected(values):
    v = np.sort(np.array(values, dtype=float))
    return [float(np.quantile(v, q)) for q in quantiles.QUARTILES]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 101])
def test_small_groups(rows, n):
    rng = np.random.default_rng(n)
    data = [("a" if i % 2 else None, float(x)) for i, x in enumerate(rng.normal(size=2 * n))]
    data += [("a", None), (None, float("nan")), ("b", None)]
    got = {r.k: r for r in quantiles.quartiles(rows("k string, x double", data), ("k",), "x").collect()}
    assert set(got) == {"a", None}
    for k, r in got.items():
        own = [x for key, x in data if key == k and x is not None and x == x]
        assert r.n == len(own) and [r.q1, r.median, r.q3] == pytest.approx(expected(own), rel=1e-12)


@pytest.mark.parametrize("shape", ["even", "skewed", "ties", "far apart"])
def test_coarse_sketch_and_hot_group(spark, shape):
    """A sketch far smaller than the group: brackets are real, and the result is exact still."""
    n = 60_000
    u = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    x = {
        "even": u,
        "skewed": F.pow(u, F.lit(20.0)) * 1e9,
        "ties": F.floor(u * 5).cast("double"),
        "far apart": F.when(u < 0.3, u).when(u < 0.6, u + 1e12).otherwise(-u * 1e-9),
    }[shape]
    key = F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    df = spark.range(n).select(key.alias("k"), x.alias("x"))
    wanted = {
        r.k: r for r in df.groupBy("k").agg(F.count("*").alias("n"), F.percentile("x", F.array(*map(F.lit, quantiles.QUARTILES))).alias("q")).collect()
    }
    for r in quantiles.quartiles(df, ("k",), "x", accuracy=200).collect():
        assert r.n == wanted[r.k].n and [r.q1, r.median, r.q3] == pytest.approx(wanted[r.k].q, rel=1e-12)
    assert len(wanted) == 11


def test_few_values_of_a_large_group_reach_the_window(spark):
    df = spark.range(200_000).select(F.lit("k").alias("k"), (F.xxhash64("id") / F.lit(2.0**40)).alias("x"))
    values = quantiles._values(df, ("k",), "x")
    cells = quantiles._cells(values, quantiles._brackets(values, ("k",), 2000), ("k",))
    assert cells.agg(F.sum("n")).first()[0] == 200_000
    assert cells.count() < 200_000 / 100


def test_boxplot_and_outliers_equal_the_counted_form(rows):
    rng = np.random.default_rng(3)
    data = [(f"g{i % 3}", float(round(x, 1))) for i, x in enumerate(rng.standard_t(2, size=3000))]
    data += [("one", 4.0), ("same", 1.0), ("same", 1.0), (None, 2.0), (None, -0.0), (None, 0.0)]
    df = rows("k string, x double", data)
    for make in (delays.boxplot, delays.boxplot_outliers):
        counted, bracketed = (
            sorted(map(tuple, make(df, ("k",), "x", continuous=c).collect()), key=repr) for c in (False, True)
        )
        assert len(counted) == len(bracketed)
        for a, b in zip(counted, bracketed):
            assert a[0] == b[0] and list(b[1:]) == pytest.approx(list(a[1:]), rel=1e-12)
    none = rows("k string, x double", [])
    assert delays.boxplot(none, ("k",), "x", continuous=True).collect() == []


def test_rows_of_a_group_are_not_sorted_to_join(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "cast(id AS double) AS x")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = quantiles.boxplot(df, ("g",), "x", 1.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in text
