"""The data of all bundle reports, every bundle in the same jobs."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions import days, match
from punctua.operators import bundles, coverage, extras, listing, pivots

# City bundles, whose reports have no stop-event sheet.
CITY_BUNDLES = ("HB Bus", "HB Tram", "BHV", "DEL", "OL Stadt")
REPORT_TIERS = ("1+", "1", "2", "Nacht")
BY = ("report_bundle",)
# Order of the rows inside each written file.
SHEET_ORDER = {
    "incidents": ("is_total", "operating_day", "tier_group"),
    "line_by_day": ("tier", "line_short"),
    "incomplete": ("-missing",),
    "extra_matches": ("tier", "line_short", "journey_no"),
    "journeys": ("tier", "line_short", "journey_no"),
    "stop_events": ("operating_day", "journey_no", "idx"),
}


# Sheets that daily counts suffice for.
COUNTED = ("incidents", "line_by_day")


def bundle_sheet(
    name: str,
    by_report: DataFrame | None,
    stops: DataFrame | None,
    extra_runs: DataFrame | None,
    as_of: str | days.Day,
    window: int = 21,
    incident_window: int = 35,
    city_bundles: tuple[str, ...] = CITY_BUNDLES,
) -> DataFrame:
    """Data of one sheet of all bundles; each row names its report bundle.

    ``by_report`` and ``stops`` come from ``bundles.journeys_by_report`` and
    ``bundles.stops_by_report``. The stop sheet needs only ``stops``, the
    others only ``by_report`` and the matches ``extra_runs``. Every sheet ends
    at ``as_of``.
    """
    day = F.col("operating_day")
    if name == "stop_events":
        recent = days.in_last_days(day, as_of, incident_window)
        return stops.where(match.none_of(F.col("report_bundle"), city_bundles) & recent)
    if name == "incidents":
        incidents = coverage.incidents_by_day(by_report, as_of, incident_window, BY, ordered=False)
        return pivots.with_total_row(incidents, ("operating_day", "tier_group"), "incidents", BY)
    if name == "line_by_day":
        shown = days.last_days(as_of, window)
        rates = coverage.line_coverage_by_day(by_report, shown[0], as_of, "ever_reported", BY)
        return pivots.line_by_day(rates, shown, BY)
    if name == "incomplete":
        return coverage.incomplete_journeys(
            by_report, as_of, window, REPORT_TIERS, "ever_reported", BY
        )
    if name == "extra_matches":
        missing = extras.without_realtime(by_report, as_of, window, "ever_reported", BY)
        return extras.only_matched(extras.match_extras(missing, extra_runs))
    if name == "journeys":
        return by_report.where(days.in_last_days(day, as_of, window))
    raise ValueError(f"no sheet is named {name!r}")


def bundle_reports(by_report: DataFrame, stops: DataFrame, extra_runs: DataFrame, *spans, **options) -> dict[str, DataFrame]:
    """Every sheet of ``bundle_sheet``, keyed by sheet."""
    return {
        name: bundle_sheet(name, by_report, stops, extra_runs, *spans, **options)
        for name in SHEET_ORDER
    }


def write_bundle_reports(
    journeys: DataFrame,
    stop_events: DataFrame,
    lines: DataFrame,
    extra_runs: DataFrame,
    target: str,
    as_of: str | days.Day,
    window: int = 21,
    incident_window: int = 35,
    counts: DataFrame | None = None,
) -> dict[str, str]:
    """Write every sheet's data below ``target``, in one folder per bundle.

    The journeys of the span are joined to their reports once and kept for the
    sheets built from them; a lost executor recomputes its part. Incidents and
    the pivot come from ``counts``, the journeys' daily counts, if given.
    """
    longest = max(window, incident_window)
    span = days.in_last_days(F.col("operating_day"), as_of, longest)
    by_report = bundles.journeys_by_report(journeys.where(span), lines)
    by_report = by_report.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stops = bundles.stops_by_report(stop_events.where(span), lines)
        sheets = bundle_reports(by_report, stops, extra_runs, as_of, window, incident_window)
        if counts is not None:
            counted = bundles.counts_by_report(counts.where(span), lines)
            for name in COUNTED:
                sheets[name] = bundle_sheet(name, counted, None, None, as_of, window, incident_window)
        written = {}
        for name, rows in sheets.items():
            written[name] = f"{target.rstrip('/')}/{name}"
            (
                rows.hint("rebalance", "report_bundle")
                .sortWithinPartitions("report_bundle", *listing.order(*SHEET_ORDER[name]))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy("report_bundle")
                .parquet(written[name])
            )
        return written
    finally:
        by_report.unpersist()
