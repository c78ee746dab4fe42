"""Archive files made of the tables: compressed, and none without an element."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from workload import QUERIES, archive_text
from workload import standins as st

SPLITS = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def orders(spark, tmp_path):
    """Tables whose one row group is cut into several splits, the first of which has no rows."""
    key = F.col("id")
    spark.range(3000).coalesce(1).select(
        key.alias("o_orderkey"), (key * 7 % 500).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "OFP")), (key % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int")).cast("timestamp_ntz").alias("o_orderdate"),
        F.when(key % 5 == 0, "1-URGENT").when(key % 5 == 1, "5-LOW").otherwise("3-MEDIUM").alias("o_orderpriority"),
        F.sha2(key.cast("string"), 256).alias("o_comment"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(5).select(key.alias("r_regionkey")).write.parquet(str(tmp_path / "region.parquet"))
    spark.range(25).select(key.alias("n_nationkey"), F.concat(F.lit("NATION_"), key).alias("n_name")).write.parquet(
        str(tmp_path / "nation.parquet")
    )
    before = {k: spark.conf.get(k) for k in SPLITS}
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    yield str(tmp_path)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_first_scan_task_without_rows(spark, orders):
    rows = st.table(spark, orders, "orders")
    assert rows.where(F.spark_partition_id() == 0).isEmpty()
    found = {r.reason: r.total for r in QUERIES["archive_rejects"].build(spark, orders).collect()}
    assert found["no element"] == 5 and sum(found.values()) == 3005
    arrivals = QUERIES["served_arrivals"].build(spark, orders).collect()
    assert sorted((r.number, r.source) for r in arrivals) == [(1, "stream"), (2, "stream"), (3, "batch"), (4, "stream")]
    assert QUERIES["streamed_archive_journeys"].build(spark, orders).count() == 3000
    assert not QUERIES["line_coverage_from_daily_counts"].build(spark, orders).isEmpty()


def test_archive_files_are_compressed(spark, tmp_path):
    folder, text = str(tmp_path / "files"), archive_text.exported(F.lit("x" * 1000))
    archive_text.write_files(spark.range(300).select(text), folder)
    files = list(Path(folder).glob("part-*"))
    assert files and sum(f.stat().st_size for f in files) < 30_000
    assert sum(gzip.open(f).read().count(b"\n") for f in files) == 300
