"""Rows carried whole through an operator, and tables written between its steps."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctua.session import shared_folder, shuffles_removed

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = str(Path(__file__).resolve().parents[2])


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """All columns of each row as the struct ``row``, beside the named ones.

    Names an operator uses inside cannot clash with the caller's columns then.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    return df.select(whole, *(c.alias(name) for name, c in named.items()))


def unpacked(df: DataFrame, *new: str) -> DataFrame:
    """The caller's columns and the new ones; a new one replaces one of its name."""
    taken = {n.lower() for n in new}
    own = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*(F.col("row")[c].alias(c) for c in own), *new)


def extended(df: DataFrame, more: str) -> StructType:
    """Schema of ``df`` followed by the fields of a schema text."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def prepare_workers(spark: SparkSession, rows: int = 1000) -> None:
    """Settings for Python tasks over texts.

    Fewer rows per Arrow batch, as texts can be long; a value the session was given stays.
    Workers look for this package where the driver has it (on a cluster without a shared
    code folder pass it with ``--py-files``).
    """
    context = spark.sparkContext
    if BATCH_ROWS not in {key for key, _ in context.getConf().getAll()}:
        spark.conf.set(BATCH_ROWS, str(rows))
    known = context.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, ROOT)))


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The table once written below ``folder``: later steps read it, none recomputes it."""
    path = f"{folder}/{name}"
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete folders and tables of ``written`` that no later step reads."""
    for place in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(df: DataFrame, purpose: str) -> str:
    return shared_folder(df.sparkSession, purpose)
