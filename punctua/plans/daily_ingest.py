"""Archive XML to typed day tables."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.functions.days import as_day
from punctua.operators.coverage import daily_counts
from punctua.operators.delays import reports_with_station_names
from punctua.operators.stations import reports_with_names_of_day, station_intervals
from punctua.schemas import struct
from punctua.sources import archive_xml, day_files, deliveries
from punctua.sources.deliveries import ACCOUNTS, DELIVERY, REJECTED, VERSION, Publication

FLATTEN = {
    "journeys": archive_xml.journeys_from_archive,
    "extras": archive_xml.journeys_from_archive,
    "stop_events": archive_xml.stop_events_from_archive,
}
COUNTS = "journey_counts"
log = logging.getLogger(__name__)


def journey_counts(archive: DataFrame) -> DataFrame:
    return daily_counts(day_files.with_short_line_id(archive_xml.journeys_from_archive(archive)))



def delay_matrix(archive: DataFrame, names_of_day: bool = False, stations: DataFrame | None = None) -> DataFrame:
    """Delay reports with station names, from one archive.

    A station that has several names in the archive repeats its reports, unless ``names_of_day``
    takes the name it had on the day of the report. The stations are counted and then joined:
    ``stations`` gives the archive's where they were stored, so that it is not parsed for each.
    """
    reports = archive_xml.delay_reports_from_archive(archive, number_as_text=True)
    if names_of_day:
        calls = archive_xml.stop_events_from_archive(archive).where("station_name <> '-'")  # '-': not named
        intervals = station_intervals(calls, ("station_name",))
        return reports_with_names_of_day(reports, intervals).select(*struct("delay_reports").fieldNames())
    listed = archive_xml.stations_from_archive(archive) if stations is None else stations
    named = reports_with_station_names(reports, listed)
    return named.select(*struct("delay_reports").fieldNames())


REJECTS = f"{archive_xml.SOURCE_FILE} string, reason string, record string"


class RejectedElements(ValueError):
    """Elements of a delivery could not be used; no table was written."""


class Stored(dict):
    """Paths by table, and the ``rows`` that the delivery has in each."""

    def __init__(self, paths: dict[str, str], rows: dict[str, int]):
        super().__init__(paths)
        self.rows = rows


def content_digest(elements: int, mixed: int, summed: int) -> str:
    """Name of a delivery's content, whatever the order of its files and elements."""
    return f"{elements}-{mixed & (2**64 - 1):016x}-{summed:x}"


def _accounted(archive: DataFrame, path: str, files: DataFrame | None) -> DataFrame:
    """The accounts of all files, written; empty files give no rows and are added by their names."""
    found = archive_xml.accounts(archive)
    if files is not None:
        found = files.join(found, archive_xml.SOURCE_FILE, "left").fillna(0)
    found.write.parquet(path)
    return archive.sparkSession.read.schema(found.schema).parquet(path)


def store_delivery(
    archive: DataFrame,
    target: str,
    delivery_day: str,
    tables: tuple[str, ...] = ("journeys", "stop_events"),
    allow_rejected: bool = False,
    source: str = "batch",
    arrival: str | None = None,
    files: DataFrame | None = None,
    names_of_day: bool = False,
) -> Stored:
    """Write the tables of one delivery below ``target`` and publish them together.

    The first pass over the archive accounts for every file and start tag (table ``accounts``).
    Elements that no table can take, and files without any element, go to the table ``rejected``;
    if there are some, nothing is published unless ``allow_rejected``. The same delivery day again
    replaces these tables of that delivery; its other tables, other deliveries and their rejects
    stay. With journeys come their daily counts (table ``journey_counts``), from which reports add
    up days and lines without reading journeys. ``files`` names all files, so that empty ones are missed.
    ``names_of_day`` as in ``delay_matrix``.
    """
    spark, target = archive.sparkSession, target.rstrip("/")
    day, version = as_day(delivery_day).isoformat(), deliveries.new_version()
    more = (COUNTS,) if "journeys" in tables else ()
    below = {t: f"{t}/{VERSION}={version}/{DELIVERY}={day}" for t in (*tables, *more, REJECTED, ACCOUNTS)}
    accounts = _accounted(archive, f"{target}/{below[ACCOUNTS]}", files)
    total = accounts.agg(
        F.count("*").alias("files"), F.count_if(F.col("elements") == 0).alias("empty"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("elements", "used", "rejected", "summed")),
        F.coalesce(F.bit_xor("mixed"), F.lit(0)).alias("mixed"),
        F.max(archive_xml.ARRIVED).cast("double").alias("at"),
    ).first()
    refused = total.rejected + total.empty
    log.info("%s: %d files, %d elements, %d used, %d refused", day, total.files, total.elements, total.used, refused)
    aside = archive_xml.rejected(archive) if total.rejected else spark.createDataFrame([], REJECTS)
    if total.empty:
        aside = aside.unionByName(archive_xml.without_elements(accounts))
    aside.write.parquet(f"{target}/{below[REJECTED]}")
    if refused and not allow_rejected:
        raise RejectedElements(f"{refused} elements of {day} cannot be used, see {target}/{below[REJECTED]}")
    rows = {REJECTED: refused, ACCOUNTS: total.files}
    for table in below:
        if table in (REJECTED, ACCOUNTS):
            continue
        if table == "delay_reports":
            made = delay_matrix(archive, names_of_day)
        else:
            made = journey_counts(archive) if table == COUNTS else FLATTEN[table](archive)
        rows[table] = day_files.write_version(made, f"{target}/{below[table]}", ("operating_day",))
    earlier = [p.arrived_at for p in deliveries.publications(spark, target) if p.delivery_day == day and p.arrived_at]
    # what is stored by hand stays until something newer than all before arrives
    at = max([*earlier, total.at or 0]) or None
    digest = content_digest(total.elements, total.mixed, total.summed)
    deliveries.publish(spark, target, [Publication(day, below, rows, source, arrival, at, digest)])
    paths = {t: f"{target}/{t}" for t in tables} | {REJECTED: f"{target}/{below[REJECTED]}"}
    return Stored(paths, rows)


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """Rejects, with their delivery day, of all publications of which some table is still present."""
    found = deliveries.side_paths(spark, target, REJECTED)
    return deliveries.read(spark, f"{REJECTS}, {DELIVERY} date", target, REJECTED, found)


def ingest_archive(
    spark: SparkSession,
    paths: str | list[str],
    target: str,
    delivery_day: str,
    tables: tuple[str, ...] = ("journeys", "stop_events"),
    allow_rejected: bool = False,
    names_of_day: bool = False,
) -> Stored:
    """``store_delivery`` of archive files.

    The parsed elements are kept on the executors' disks while the tables are
    written, as parsing costs far more than reading them back; what a lost
    executor held is parsed again.
    """
    archive = archive_xml.read_archive(spark, paths).persist(StorageLevel.DISK_ONLY)
    try:
        files = archive_xml.file_names(spark, paths)
        return store_delivery(
            archive, target, delivery_day, tables, allow_rejected, files=files, names_of_day=names_of_day
        )
    finally:
        archive.unpersist()
