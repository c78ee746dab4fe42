"""Newly landed archive files: a stream lands each file once, a batch step serves deliveries.

The stream is stateless; no watermark or window is needed. The file source
remembers in the checkpoint which files it has read, and the file sink commits
each batch as a whole, so a restarted run repeats nothing. Its log makes the
landing table unfit for batch writes; what reports read is therefore written
by ``serve_deliveries`` through the same code as the daily batch job. Both note what they
serve in the manifests of the tables (``sources.deliveries``).
"""

from __future__ import annotations

import logging
import re
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctua.plans.daily_ingest import content_digest, store_delivery
from punctua.sources import archive_xml, deliveries
from punctua.sources.deliveries import DELIVERY

LANDED = f"""element string, {archive_xml.UNENDED} string, {archive_xml.SOURCE_FILE} string,
    arrived_at timestamp, arrival string, place string, {DELIVERY} date"""
# The day in a file's path, and what marks files of extra journeys.
DAY_IN_PATH = r"(\d{4}-\d{2}-\d{2})"
EXTRA_IN_PATH = r"\d{4}-\d{2}-\d{2}[-_]extras?(?![A-Za-z])|(?<![A-Za-z])extras?[-_]\d{4}-\d{2}-\d{2}"
# What may follow the day in the name of a delivery that comes again.
AGAIN_IN_NAME = r"(\.[A-Za-z]+)?|[-_](again|[a-z]|v?\d+)(\.[A-Za-z]+)?"
EXTRAS, MAIN = ("extras",), ("journeys", "stop_events")
log = logging.getLogger(__name__)


class UnclearArrivals(ValueError):
    """Arrivals of one day that need not be the same delivery; nothing of that day was stored."""


def _below(folder: str) -> Column:
    """The part of a file's path below ``folder``, up to whose first wildcard it is the same for all."""
    fixed = re.sub(r"^\w+:/*", "/", re.split(r"[*?\[{]", folder)[0])
    fixed = fixed[: fixed.rfind("/") + 1] if re.search(r"[*?\[{]", folder) else fixed.rstrip("/") + "/"
    path = F.col(archive_xml.SOURCE_FILE)
    at = F.instr(path, fixed)
    return F.when(at > 0, F.substring(path, at + F.lit(len(fixed)), F.length(path))).otherwise(path)


def _arrival(path: Column, day_pattern: str) -> Column:
    """The last folder named by a day, or else the file named by one, or else the file's folder."""
    dated_folder = F.regexp_extract(path, rf"^(.*{day_pattern}[^/]*)/", 1)
    folder = F.regexp_extract(path, r"^(.*)/", 1)
    by_name = F.when(F.regexp_like(path, F.lit(day_pattern)), path).otherwise(folder)
    return F.when(dated_folder != "", dated_folder).otherwise(by_name)


def land_new_files(
    spark: SparkSession,
    folder: str,
    landing: str,
    checkpoint: str,
    day_pattern: str = DAY_IN_PATH,
    arrival_pattern: str | None = None,
    recursive: bool = True,
) -> StreamingQuery:
    """Append the elements of files that landed since the last run, then stop.

    ``checkpoint`` must be a lasting folder of this job alone. A file's
    delivery day is the last match of ``day_pattern`` in its path below
    ``folder``, or else the day of its arrival. The files of a folder named by a day are one arrival,
    those of its subfolders too; a file named by a day in a folder that is not
    is an arrival of its own, and undated files of a folder are one. If files
    of one delivery have only part of their names in common, let
    ``arrival_pattern`` pick it. Folders are listed with their subfolders
    unless ``recursive`` is false.
    The tasks follow the size of the files; nothing is shuffled.
    """
    path = F.col(archive_xml.SOURCE_FILE)
    below = _below(folder)
    named = F.try_element_at(F.regexp_extract_all(below, F.lit(day_pattern), 1), F.lit(-1)).try_cast("date")
    arrival = _arrival(below, day_pattern)
    if arrival_pattern is not None:
        # a path without match is an arrival by the general rule, never one with all others
        picked = F.regexp_extract(path, arrival_pattern, 1)
        arrival = F.when(picked != "", picked).otherwise(arrival)
    rows = archive_xml.stream_candidates(spark, folder, recursive=recursive)
    return (
        rows.withColumns({"arrival": arrival, "place": below})
        .withColumn(DELIVERY, F.coalesce(named, F.to_date("arrived_at")))
        .writeStream.format("parquet")
        .partitionBy(DELIVERY)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(landing)
    )


def newest_arrivals(landed: DataFrame) -> DataFrame:
    """The elements of the last arrival of each delivery day; of equal times, the last name."""
    newest = _arrivals(landed).groupBy(DELIVERY).agg(F.max(F.struct("at", "arrival"))["arrival"].alias("arrival"))
    return landed.join(newest, [DELIVERY, "arrival"], "left_semi")


def _arrivals(landed: DataFrame) -> DataFrame:
    """A row per arrival: day, name, time of its newest file, and what names its content."""
    text = F.coalesce(F.col(archive_xml.UNENDED), F.col("element"))
    hashed = F.when(text.isNotNull(), F.xxhash64(text))
    return landed.groupBy(DELIVERY, "arrival").agg(
        F.max("arrived_at").cast("double").alias("at"), F.count(hashed).alias("elements"),
        F.coalesce(F.bit_xor(hashed), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(F.pmod(hashed, F.lit(1 << 31))), F.lit(0)).alias("summed"),
    )


def _refuse_unclear(day: str, names: list[str], again_pattern: str) -> None:
    """All arrivals of a day must be one delivery coming again, by what follows the day in their names."""
    other = [n for n in names if not re.fullmatch(again_pattern, n.rsplit(day, 1)[-1].split("/")[0])]
    if len(names) > 1 and other:
        raise UnclearArrivals(f"{day}: is {', '.join(other)} the delivery {day} again? Say so by a pattern")


def serve_deliveries(
    spark: SparkSession,
    landing: str,
    target: str,
    tables: tuple[str, ...] | None = None,
    since: str | None = None,
    allow_rejected: bool = False,
    extra: bool = False,
    extra_pattern: str = EXTRA_IN_PATH,
    again_pattern: str = AGAIN_IN_NAME,
) -> list[str]:
    """Publish the newest arrival of each landed delivery day that is newer than what is served,
    and return these days.

    The manifests below ``target`` tell what is served, by this function or by batch: a day of
    which all ``tables`` are there from an arrival as new, or from a batch job whose files or
    whose predecessor were as new, is left alone, so a correction by hand stays until something
    newer arrives. An arrival with the served content is noted without being written again.
    ``since``: only deliveries from this day on. Files whose path below the landed folder matches
    ``extra_pattern`` are extra deliveries: they are served, and alone, if ``extra``, and only
    into the table extras. Several arrivals of a day must be named so that ``again_pattern``
    matches what follows the day in their names; else the day is refused. Older arrivals left out
    are logged with their number. The loop runs over days to be served, each a batch job of its
    own size.
    """
    tables = tables or (EXTRAS if extra else MAIN)
    if extra != (tuple(tables) == EXTRAS):
        raise ValueError("extra deliveries are served into the table extras alone, others into the others")
    landed = spark.read.schema(LANDED).parquet(landing)
    if since is not None:
        landed = landed.where(F.col(DELIVERY) >= F.lit(since).cast("date"))
    is_extra = F.regexp_like(F.coalesce("place", archive_xml.SOURCE_FILE), F.lit(extra_pattern))
    landed = landed.where(is_extra if extra else ~is_extra)
    served = deliveries.current(deliveries.publications(spark, target))
    by_day: dict[str, list] = {}
    for row in _arrivals(landed).collect():
        by_day.setdefault(row[DELIVERY].isoformat(), []).append(row)
    days = []
    for day, arrivals in sorted(by_day.items()):
        newest = max(arrivals, key=lambda r: (r.at, r.arrival))
        before = [served.get((day, table)) for table in tables]
        if all(p is not None and _as_new(p, newest) for p in before):
            continue
        _refuse_unclear(day, [r.arrival for r in arrivals], again_pattern)
        if len(arrivals) > 1:
            log.warning("%s: %d older arrivals are left out", day, len(arrivals) - 1)
        digest = content_digest(newest.elements, newest.mixed, newest.summed)
        last = before[0]
        if last is not None and last.digest == digest and all(p == last for p in before):
            again = replace(last, source="stream", arrival=newest.arrival, arrived_at=newest.at)
            deliveries.publish(spark, target.rstrip("/"), [again])
            continue
        one = landed.where((F.col(DELIVERY) == F.lit(day).cast("date")) & (F.col("arrival") == newest.arrival))
        archive = archive_xml.parse_archive(one, "element").persist(StorageLevel.DISK_ONLY)
        try:
            store_delivery(archive, target, day, tables, allow_rejected, "stream", newest.arrival)
        finally:
            archive.unpersist()
        days.append(day)
    return days


def _as_new(served: deliveries.Publication, newest: Row) -> bool:
    at = served.arrived_at or 0
    return at > newest.at or (at == newest.at and (served.arrival is None or served.arrival >= newest.arrival))
