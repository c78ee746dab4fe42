"""Line master data and publication targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.schemas import OLD_NAMES, struct


def active_lines(raw: DataFrame, rt_operator: bool = False) -> DataFrame:
    """Active lines that belong to a bundle, from the raw line table.

    ``rt_operator`` adds the empty column that the cached line list carries.
    """
    columns = [
        F.col("nummer").cast("string").alias("line"),
        F.col("buendel").alias("bundle"),
        F.col("ebene").alias("tier"),
        F.col("dlid").alias("line_id_short"),
        F.col("id").cast("string").alias("id"),
    ]
    if rt_operator:
        columns.insert(2, F.lit("").alias("rt_operator"))
    return raw.where(F.col("buendel").isNotNull() & F.col("aktiv")).select(columns)


def read_lines_jdbc(
    spark: SparkSession, url: str, table: str, **properties: str
) -> DataFrame:
    """Lines from a relational database; projection and filter run in the database."""
    raw = spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
    return active_lines(raw)


def read_bundles_jdbc(
    spark: SparkSession, url: str, table: str, **properties: str
) -> DataFrame:
    """The bundle table as it is."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()


def read_lines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cached line list (';' separated, with header), in our or the older column names.

    The caller chooses this or the database; nothing falls back silently.
    """
    raw = spark.read.option("sep", ";").option("header", "true").csv(path)
    old = OLD_NAMES["lines"]
    raw = raw.withColumnsRenamed({name: old[name] for name in raw.columns if name in old})
    return raw.select([F.col(f.name).cast(f.dataType) for f in struct("lines").fields])


def write_lines_csv(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").option("sep", ";").option("header", "true").csv(path)


def read_publication_targets(spark: SparkSession, path: str) -> DataFrame:
    """Publication list: ';' separated, quoted with single quotes, with header."""
    raw = spark.read.option("sep", ";").option("quote", "'").option("header", "true").csv(path)
    old = OLD_NAMES["publication_targets"]
    raw = raw.withColumnsRenamed({name: old[name] for name in raw.columns if name in old})
    return raw.select([F.col(f.name).cast(f.dataType) for f in struct("publication_targets").fields])
