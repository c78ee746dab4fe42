"""Named views and tables, for users who prefer SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(spark: SparkSession, **tables: DataFrame) -> None:
    """Make DataFrames known to SQL under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """All columns and rows of a named table or view."""
    return spark.table(name)


def scan_day(spark: SparkSession, table: str, day: str) -> DataFrame:
    """One operating day of a named table.

    Where the older archive kept a table per day (``table_yyyy_mm_dd``), one
    table pruned by day gives the same rows.
    """
    return spark.table(table).where(F.col("operating_day") == F.lit(day).cast("date"))


def list_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("DESCRIBE IDENTIFIER(:name)", {"name": name})


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a result once and return the scan of what was written.

    Cuts the plan without depending on any executor's memory or disk.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
