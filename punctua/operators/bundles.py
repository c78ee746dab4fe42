"""Joins of facts to lines and bundles.

Lines are master data, yet Spark's estimate of them is often far too high:
unknown for a database, multiplied by every join. ``if_small`` therefore
counts them before they are broadcast. Beyond its limits the joins are left to
Spark, which sort-merges and splits lines that hold too many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions import days
from punctua.functions.text import slug
from punctua.operators.listing import sort

# Fixed value: the bundle left out of the reports.
UNREPORTED = ("nahsh",)

# A line list up to this size is broadcast.
SMALL_ROWS, SMALL_BYTES = 100_000, 16 << 20

JOURNEY_VIEW = (
    "operating_day", "tier", "operator", "journey_no", "start_station", "end_station",
    "line_short", "line_id_short", "has_realtime", "journey_cancelled",
    "reported_cancelled", "ts_reported_cancelled", "ever_reported",
)
STOP_VIEW = (
    "operating_day", "tier", "journey_no", "idx", "station_no", "station_name",
    "arr_delay", "dep_delay", "reported_cancelled", "cancelled",
)


def if_small(side: DataFrame, most_rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> DataFrame:
    """The same rows, marked for broadcast if a count finds them within the limits.

    Runs a job over at most ``most_rows`` + 1 rows of the small side.
    """
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in side.columns]
    size = side.limit(most_rows + 1).agg(
        F.count("*").alias("rows"), F.sum(sum(texts, F.lit(0))).alias("bytes")
    ).first()
    fits = size.rows <= most_rows and (size.bytes or 0) <= most_bytes
    return F.broadcast(side) if fits else side


def with_lines(facts: DataFrame, lines: DataFrame, most_rows: int = SMALL_ROWS) -> DataFrame:
    """Facts with bundle and tier of their line; facts of unknown lines drop out."""
    known = lines.select("line_id_short", "bundle", "tier")
    return facts.join(if_small(known, most_rows), "line_id_short", "inner")


def bundle_filter(bundle: str, match: str) -> Column:
    """Bundles whose name contains the text, or equals it."""
    if match == "contains":
        return F.col("bundle").contains(bundle)
    if match == "equals":
        return F.col("bundle") == bundle
    raise ValueError(f"match must be 'contains' or 'equals', not {match!r}")


def journeys_of_bundle(
    journeys: DataFrame, lines: DataFrame, bundle: str, match: str = "contains"
) -> DataFrame:
    """Journeys of one bundle with their tier."""
    chosen = lines.where(bundle_filter(bundle, match))
    return with_lines(journeys, chosen).select(*JOURNEY_VIEW)


def stops_of_bundle(
    stop_events: DataFrame,
    lines: DataFrame,
    bundle: str,
    as_of: str | days.Day,
    window: int = 35,
    match: str = "equals",
    ordered: bool = False,
) -> DataFrame:
    """Stop events of one bundle with their tier, of the days up to ``as_of``.

    ``ordered`` sorts the rows by day, journey and stop.
    """
    chosen = lines.where(bundle_filter(bundle, match))
    recent = stop_events.where(days.in_last_days(F.col("operating_day"), as_of, window))
    view = with_lines(recent, chosen).select(*STOP_VIEW)
    return sort(view, "operating_day", "journey_no", "idx") if ordered else view


def bundle_list(lines: DataFrame, unreported: tuple[str, ...] = UNREPORTED) -> DataFrame:
    """Distinct reported bundles; lines without a bundle drop out."""
    return lines.where(~F.col("bundle").isin(*unreported)).select("bundle").distinct()


def nested_bundles(lines: DataFrame, unreported: tuple[str, ...] = UNREPORTED) -> DataFrame:
    """Pairs (report_bundle, bundle) where the second name contains the first.

    A report filters journeys by a part of the bundle name, so a bundle also
    shows up in the reports of every bundle whose name lies inside its own.
    Each name is spread into its parts of the lengths that reported names have,
    and joined by equality, which avoids comparing every name with every other.
    The lengths, no more than the longest name has characters, are collected first.
    """
    reported = bundle_list(lines, unreported).withColumnRenamed("bundle", "report_bundle")
    lengths = [r[0] for r in reported.select(F.length("report_bundle")).distinct().collect()]
    spread = spread_names(lines, lengths)
    return spread.join(reported, "report_bundle", "inner").select("report_bundle", "bundle")


def spread_names(lines: DataFrame, lengths: list[int]) -> DataFrame:
    """(bundle, report_bundle): distinct parts of each bundle name that have one of these lengths."""
    names = lines.where(F.col("bundle").isNotNull()).select("bundle").distinct()
    size = F.length("bundle")
    none = F.array().cast("array<string>")

    def windows(length: int) -> Column:
        if length == 0:  # every name contains the empty one
            return F.array(F.lit(""))
        starts = F.sequence(F.lit(1), size - length + 1)
        cut = F.transform(starts, lambda start: F.substring(F.col("bundle"), start, F.lit(length)))
        return F.when(size >= length, cut).otherwise(none)

    parts = F.array_distinct(F.concat(none, *map(windows, sorted(set(lengths)))))
    return names.select("bundle", F.explode(parts).alias("report_bundle"))


def lines_by_report(
    lines: DataFrame, match: str = "contains", unreported: tuple[str, ...] = UNREPORTED
) -> DataFrame:
    """Line, tier and the report each line belongs to, for all reports at once."""
    if match == "contains":
        named = lines.join(nested_bundles(lines, unreported), "bundle", "inner")
    elif match == "equals":
        named = lines.where(~F.col("bundle").isin(*unreported))
        named = named.withColumn("report_bundle", F.col("bundle"))
    else:
        raise ValueError(f"match must be 'contains' or 'equals', not {match!r}")
    return named.select("report_bundle", "bundle", "tier", "line_id_short")


def journeys_by_report(
    journeys: DataFrame, lines: DataFrame, unreported: tuple[str, ...] = UNREPORTED
) -> DataFrame:
    """The journey views of all bundles in one DataFrame."""
    chosen = lines_by_report(lines, "contains", unreported).drop("bundle")
    joined = journeys.join(if_small(chosen), "line_id_short", "inner")
    return joined.select("report_bundle", *JOURNEY_VIEW)


def counts_by_report(
    counts: DataFrame, lines: DataFrame, unreported: tuple[str, ...] = UNREPORTED
) -> DataFrame:
    """Daily counts of the journeys (``coverage.daily_counts``) of all bundles in one DataFrame."""
    chosen = lines_by_report(lines, "contains", unreported).drop("bundle")
    return counts.join(if_small(chosen), "line_id_short", "inner")


def stops_by_report(
    stop_events: DataFrame, lines: DataFrame, unreported: tuple[str, ...] = UNREPORTED
) -> DataFrame:
    """The stop-event views of all bundles in one DataFrame."""
    chosen = lines_by_report(lines, "equals", unreported).drop("bundle")
    joined = stop_events.join(if_small(chosen), "line_id_short", "inner")
    return joined.select("report_bundle", *STOP_VIEW)


def published(bundles: DataFrame, targets: DataFrame) -> DataFrame:
    """Bundles with their publication target."""
    keyed = bundles.withColumn("slug", slug(F.col("bundle")))
    return keyed.join(targets, "slug", "inner")


def unpublished(bundles: DataFrame, targets: DataFrame) -> DataFrame:
    """Bundles the publication list does not know."""
    keyed = bundles.withColumn("slug", slug(F.col("bundle")))
    return keyed.join(targets.select("slug"), "slug", "left_anti")
