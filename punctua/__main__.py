"""Daily jobs: ``ingest`` a delivery, ``land`` and ``serve`` streamed ones, ``report``, ``delays``, ``publish``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from punctua.functions import days
from punctua.operators import bundles
from punctua.operators.extras import extra_journeys
from punctua.plans.bundle_report import write_bundle_reports
from punctua.plans.daily_ingest import COUNTS, FLATTEN, Stored, ingest_archive
from punctua.plans.delay_lists import delay_lists, write_lists
from punctua.session import build_session
from punctua.sources import clustered, day_files, deliveries, master
from punctua.streaming.ingest import AGAIN_IN_NAME, DAY_IN_PATH, EXTRA_IN_PATH, MAIN, land_new_files, serve_deliveries

INGESTED = (*FLATTEN, "delay_reports")


def _lines_from(command: argparse.ArgumentParser) -> None:
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--lines", help="line list, ';' separated")
    source.add_argument("--lines-jdbc", nargs=2, metavar=("URL", "TABLE"), help="line table of a database")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="punctua", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", help="archive XML of one delivery to day tables")
    ingest.add_argument("xml", nargs="+", help="files, folders or globs")
    ingest.add_argument("--delivery-day", required=True, type=days.as_day)
    ingest.add_argument("--names-of-day", action="store_true", help="delay reports take the station's name of their day, none twice")
    land = commands.add_parser("land", help="append newly landed archive files to a landing table")
    land.add_argument("folder")
    land.add_argument("--landing", required=True)
    land.add_argument("--checkpoint", required=True)
    land.add_argument("--day-pattern", default=DAY_IN_PATH, help="the delivery day in a path, as group 1")
    land.add_argument("--arrival-pattern", help="what the paths of one arrival have in common, as group 1")
    land.add_argument("--recursive", action=argparse.BooleanOptionalAction, default=True, help="also list subfolders")
    serve = commands.add_parser("serve", help="newest arrivals of the landing table to day tables")
    serve.add_argument("--landing", required=True)
    serve.add_argument("--since", type=days.as_day, help="first delivery day")
    serve.add_argument("--extra", action="store_true", help="the deliveries of extra journeys, not the main ones")
    serve.add_argument("--extra-pattern", default=EXTRA_IN_PATH, help="what marks their paths")
    serve.add_argument("--again-pattern", default=AGAIN_IN_NAME, help="what may follow the day in a redelivery's name")
    for writes in (ingest, serve):
        writes.add_argument("--target", required=True, help="folder of the day tables")
        writes.add_argument("--tables", nargs="+", choices=INGESTED, help="default: extras with --extra, else journeys and stop_events")
        writes.add_argument("--allow-rejected", action="store_true", help="go on without elements that cannot be used")
    report = commands.add_parser("report", help="all sheets of all bundles")
    _lines_from(report)
    report.add_argument("--days", type=int, default=21)
    report.add_argument("--incident-days", type=int, default=35)
    report.add_argument("--extra-days", type=int, default=30)
    report.add_argument("--extra-lines", help="pattern the line id of an extra journey must match")
    late = commands.add_parser("delays", help="flat zeros, boxplots, segments, reports beside stops")
    late.add_argument("--days", type=int, default=28)
    late.add_argument("--reports", action="store_true", help="also use the table delay_reports")
    for reads in (report, late):
        reads.add_argument("--tables", required=True, help="folder of the day tables")
        reads.add_argument("--target", required=True)
        reads.add_argument("--as-of", required=True, type=days.as_day)
    expire = commands.add_parser("expire", help="delete versions of day tables that no delivery uses any more")
    expire.add_argument("--target", required=True, help="folder of the day tables")
    cluster = commands.add_parser("cluster", help="lay out new deliveries by journey, beside the day tables")
    cluster.add_argument("--target", required=True, help="folder of the day tables")
    cluster.add_argument("--tables", nargs="+", choices=INGESTED, default=["stop_events"])
    cluster.add_argument("--buckets", required=True, type=int, help="the same for tables to be joined")
    publish = commands.add_parser("publish", help="bundles with and without a publication target")
    _lines_from(publish)
    publish.add_argument("--targets", required=True, help="publication list, ';' separated")
    publish.add_argument("--target", required=True)
    return top


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.lines_jdbc:
        return master.read_lines_jdbc(spark, *args.lines_jdbc)
    return master.read_lines_csv(spark, args.lines)


def _counts(spark: SparkSession, tables: str) -> DataFrame | None:
    """Daily counts of the journeys, if every delivery of them has its own."""
    root = tables.rstrip("/")
    if deliveries.delivery_days(spark, root, "journeys") != deliveries.delivery_days(spark, root, COUNTS):
        return None
    return day_files.read_days(spark, COUNTS, f"{root}/{COUNTS}")


def _report(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    tables = {
        name: day_files.read_days(spark, name, f"{args.tables.rstrip('/')}/{name}")
        for name in ("journeys", "stop_events", "extras")
    }
    extra = extra_journeys(tables["extras"], args.as_of, args.extra_days, args.extra_lines)
    return write_bundle_reports(
        day_files.with_short_line_id(tables["journeys"]),
        day_files.with_short_line_id(tables["stop_events"]),
        _lines(spark, args), extra, args.target, args.as_of, args.days, args.incident_days, _counts(spark, args.tables),
    )


def main(arguments: list[str] | None = None) -> dict[str, str]:
    args = parser().parse_args(arguments)
    spark = build_session(f"punctua-{args.command}")
    if args.command == "ingest":
        return ingest_archive(
            spark, args.xml, args.target, args.delivery_day, tuple(args.tables or MAIN), args.allow_rejected,
            args.names_of_day,
        )
    if args.command == "land":
        land_new_files(
            spark, args.folder, args.landing, args.checkpoint, args.day_pattern, args.arrival_pattern, args.recursive
        ).awaitTermination()
        return {"landing": args.landing}
    if args.command == "serve":
        served = serve_deliveries(
            spark, args.landing, args.target, tuple(args.tables or ()), args.since, args.allow_rejected,
            args.extra, args.extra_pattern, args.again_pattern,
        )
        return {day: args.target for day in served}
    if args.command == "expire":
        return {path: "deleted" for path in deliveries.expire(spark, args.target.rstrip("/"))}
    if args.command == "cluster":
        done = {table: clustered.cluster_days(spark, args.target, table, args.buckets) for table in args.tables}
        return {table: ", ".join(map(str, days)) or "up to date" for table, days in done.items()}
    if args.command == "report":
        return _report(spark, args)
    if args.command == "delays":
        folder = args.tables.rstrip("/")
        stops = day_files.read_days(spark, "stop_events", f"{folder}/stop_events")
        reports = day_files.read_days(spark, "delay_reports", f"{folder}/delay_reports") if args.reports else None
        return write_lists(delay_lists(stops, reports, args.as_of, args.days), args.target)
    listed = bundles.bundle_list(_lines(spark, args))
    targets = master.read_publication_targets(spark, args.targets)
    lists = {"published": bundles.published(listed, targets), "unpublished": bundles.unpublished(listed, targets)}
    return write_lists(lists, args.target)


if __name__ == "__main__":
    done = main()
    for name, path in done.items():
        print(name, path, *([f"{done.rows[name]} rows"] if isinstance(done, Stored) else []))
