"""Parquet day tables: aligned reads, deliveries stored so that a repeated one replaces itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    LongType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
)

from punctua.functions.days import as_day
from punctua.functions.text import line_id_padded
from punctua.schemas import OLD_NAMES, TABLES, struct
from punctua.session import shuffles_removed
from punctua.sources import deliveries
from punctua.sources.deliveries import DELIVERY, VERSION, Publication

SOURCE_FILE = "source_file"


def _convert(name: str, have: DataType, want: DataType) -> Column:
    value = F.col(f"`{name}`")
    if have == want:
        return value
    if isinstance(have, LongType) and isinstance(want, (DateType, TimestampNTZType)):
        # nanoseconds since 1970, as pandas stores local times; zone-free arithmetic
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.floor(value / F.lit(1000)).cast("bigint")
        return F.timestamp_add("MICROSECOND", micros, epoch).cast(want)
    if isinstance(have, StringType) and isinstance(want, BooleanType):
        return F.lower(value).try_cast("boolean")
    if isinstance(have, StringType) and isinstance(want, DateType):
        return F.substring(value, 1, 10).try_cast("date")
    if isinstance(have, StringType) and isinstance(want, (NumericType, TimestampNTZType)):
        return value.try_cast(want)
    return value.cast(want)


def align(df: DataFrame, schema: StructType, names: dict[str, str] | None = None) -> DataFrame:
    """Project onto a declared schema: rename, convert, fill missing columns with NULL."""
    if names:
        df = df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})
    have = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        found = have.get(field.name.lower())
        value = F.lit(None) if found is None else _convert(found.name, found.dataType, field.dataType)
        columns.append(value.cast(field.dataType).alias(field.name))
    if SOURCE_FILE in df.columns:
        columns.append(F.col(SOURCE_FILE))
    return df.select(columns)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column missing in one of them is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_day_files(
    spark: SparkSession,
    table: str,
    globs: list[str],
    source_file: bool = False,
    schemas: dict[str, str] | None = None,
) -> DataFrame:
    """Union of day files by column name, in the declared types of ``table``.

    Give one glob per generation of files: within a glob the stored types are
    equal, across globs they may differ. Old column names are understood. A
    glob named in ``schemas`` is read with that schema, the others by merging
    the footers of their files.
    """
    frames = []
    for glob in globs:
        known = (schemas or {}).get(glob)
        read = spark.read.schema(known) if known else spark.read.option("mergeSchema", "true")
        part = read.parquet(glob)
        if source_file:
            part = part.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        part = align(part, struct(table), OLD_NAMES.get(table))
        frames.append(with_short_line_id(part))
    return union_by_name(frames)


def with_short_line_id(df: DataFrame) -> DataFrame:
    """Derive the short line id that facts join to lines on."""
    if "line_id" not in df.columns or "line_id_short" not in df.columns:
        return df
    return df.withColumn("line_id_short", line_id_padded(F.col("line_id")))


def read_days(
    spark: SparkSession, table: str, path: str, delivery_day: bool = False
) -> DataFrame:
    """All present deliveries of a table written by ``write_days``; day predicates prune its folders.

    ``delivery_day`` adds the delivery each row came with. Of each delivery the last published
    version is read, as the manifests stand now; a table without deliveries is empty.
    """
    schema = f"{TABLES[table]}, {DELIVERY} date"
    root, name = deliveries.home(spark, path)
    if deliveries.exists(spark, f"{root}/{deliveries.FOLDER}"):
        stored = deliveries.read(spark, schema, root, name, deliveries.paths(spark, root, name))
    else:
        stored = spark.read.schema(schema).parquet(path)
    return stored if delivery_day else stored.drop(DELIVERY)


def newest_rows(
    stored: DataFrame, keys: tuple[str, ...] = ("operating_day", "line_id", "journey_no"), number: str = "journey_no"
) -> DataFrame:
    """Of each key the rows of the newest delivery that has it; ``stored`` as ``read_days`` gives it
    with the delivery day.

    What an earlier delivery says of a journey that came again is left out; a delivery's own rows
    of one key all stay. Rows without a journey number are of no known journey and all stay. The
    older rows that one scan task sees leave there (window group limit).
    """
    unknown = F.coalesce(F.trim(number) == "", F.lit(True))
    newest = Window.partitionBy(*keys).orderBy(F.col(DELIVERY).desc())
    known = stored.where(~unknown).withColumn("_age", F.rank().over(newest)).where("_age = 1").drop("_age")
    return known.unionByName(stored.where(unknown))


def read_day(spark: SparkSession, table: str, path: str, day: str) -> DataFrame:
    """One operating day of a table, from all deliveries."""
    return read_days(spark, table, path).where(F.col("operating_day") == F.lit(day).cast("date"))


def is_stream_table(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink keeps its log there; readers then see only its files."""
    log = spark._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def write_version(
    df: DataFrame, path: str, partitions: tuple[str, ...], sort_by: tuple[str, ...] = ("line_id",)
) -> int:
    """Write rows into a new folder and return their number, counted as they are written.

    The rebalance keeps a day's rows together where they are few and splits a large day over
    several tasks and files; sorting inside the tasks lets row groups be skipped by line.
    """
    keys = [c for c in sort_by if c in df.columns]
    counted = Observation()
    with shuffles_removed(df.sparkSession):
        (
            df.hint("rebalance", *partitions)
            .observe(counted, F.count(F.lit(1)).alias("rows"))
            .sortWithinPartitions(*partitions, *keys)
            .write.partitionBy(*partitions)
            .parquet(path)
        )
    return counted.get["rows"]


def write_days(
    df: DataFrame, path: str, delivery_day: str, sort_by: tuple[str, ...] = ("line_id",)
) -> int:
    """Store one delivery and return its number of rows.

    The same delivery day again replaces it, nothing else is touched. A delivery may hold rows of
    any operating days: they lie beside those that other deliveries brought for the same days.
    """
    spark = df.sparkSession
    if is_stream_table(spark, path):
        raise ValueError(f"{path} is written by a stream; give deliveries a folder of their own")
    day = as_day(delivery_day).isoformat()
    root, name = deliveries.home(spark, path)
    below = f"{VERSION}={deliveries.new_version()}/{DELIVERY}={day}"
    below = f"{name}/{below}" if name else below
    rows = write_version(df.drop(DELIVERY), f"{root}/{below}", ("operating_day",), sort_by)
    deliveries.publish(spark, root, [Publication(day, {name: below}, {name: rows})])
    return rows


def migrate_day_files(
    spark: SparkSession,
    table: str,
    globs: list[str],
    path: str,
    schemas: dict[str, str] | None = None,
) -> DataFrame:
    """Store old day files once as a table of ``write_days`` and return it.

    Each operating day counts as a delivery of its own. ``schemas`` gives the
    stored schema of a glob; without it the footers of all its files are read
    and merged. Converted columns cannot be pushed into old files, so every
    later read should go to the result. Rows whose day cannot be read stay in
    the partition without a day. A target that holds deliveries already is refused.
    """
    root, name = deliveries.home(spark, path)
    kept = [n for n in deliveries.names(spark, path) if n.startswith((VERSION, DELIVERY))]
    if kept or (name and deliveries.paths(spark, root, name)):
        raise ValueError(f"{path} holds deliveries; migrate into a folder of its own")
    rows = read_day_files(spark, table, globs, schemas=schemas)
    dated = rows.withColumn(DELIVERY, F.col("operating_day"))
    version = f"{VERSION}={deliveries.new_version()}"
    version = f"{name}/{version}" if name else version
    write_version(dated, f"{root}/{version}", (DELIVERY, "operating_day"))
    days = [n for n in deliveries.names(spark, f"{root}/{version}") if n.startswith(f"{DELIVERY}=")]
    lines = [
        Publication(None if "__HIVE" in n else n.partition("=")[2], {name: f"{version}/{n}"}, source="migrated")
        for n in days
    ]
    deliveries.publish(spark, root, lines)
    return read_days(spark, table, path)
