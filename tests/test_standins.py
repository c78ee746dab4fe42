"""Stop events are sorted and shuffled narrow, and deliveries to be clustered are written in one pass."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from workload import source_queries
from workload import standins as st


@pytest.fixture
def items(spark, tmp_path):
    n = F.col("id")
    spark.range(400).select(
        (n / 4 * 7).cast("bigint").alias("l_orderkey"), (n % 9).alias("l_partkey"), (n % 7).alias("l_suppkey"),
        (n % 3).cast("int").alias("l_linenumber"), (n % 50).cast("double").alias("l_quantity"),
        (n * 1.5).alias("l_extendedprice"), (n % 3 / 100).alias("l_discount"), (n % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (n % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(n % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_only_stored_columns_are_shuffled(spark, items):
    stops = st.stop_events(spark, items)
    below = stops._jdf.queryExecution().optimizedPlan().toString().split("Window")[-1]
    assert "sched_dep" not in below and "lat#" not in below and "device_id" not in below
    whole = st.stop_reports(spark, items).drop("report_no", "report_size")
    assert stops.columns == whole.columns and stops.count() > 0
    assert stops.exceptAll(whole).isEmpty()  # each is a report as it stands


def test_deliveries_come_of_one_pass(spark, items, tmp_path):
    root = str(tmp_path / "root")
    stops = source_queries._dated(st.stop_events(spark, items))
    stored = source_queries._clustered(spark, root, "stop_events", stops)
    assert stored.count() == stops.count()
    versions = list(Path(root, "stop_events").glob("version=*"))
    assert len(versions) == 1
    assert {p.name for p in versions[0].glob("delivery_day=*")} == {"delivery_day=2001-07-30", "delivery_day=2001-07-31"}
