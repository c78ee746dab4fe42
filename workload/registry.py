"""Collects registered queries with the inventory ids they cover and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from workload.standins import PRELUDE

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Days and local times as text, so that every engine shows them alike."""
    kinds = (DateType, TimestampNTZType)
    columns = [
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, kinds)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(columns)


def query(ids: str, sql: str | None, prelude: bool = True) -> Callable[[Build], Build]:
    """Register a function under its own name."""

    def add(build: Build) -> Build:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        text = None if sql is None else (PRELUDE + sql if prelude else sql)
        QUERIES[name] = Query(name, tuple(ids.split()), lambda s, d: plain(build(s, d)), text)
        return build

    return add
