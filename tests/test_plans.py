"""Physical plans: what reaches the scan, and what must not appear."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from punctua.functions import days
from punctua.operators import bundles, coverage, delays, pivots, segments
from workload import QUERIES
from workload import standins as st


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


WRITING = {
    "streamed_archive_journeys", "rewritten_days", "redelivered_days", "archive_rejects",
    "day_files_of_two_generations", "materialised_result",
    "next_stops_of_clustered_days", "reports_with_clustered_stops",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name].build(spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def stored_journeys(spark, tmp_path):
    from punctua.sources import day_files

    rows = st.journeys(spark, SF_DIR).withColumn("operating_day", F.trunc("operating_day", "year"))
    day_files.write_days(rows, str(tmp_path / "journeys"), st.AS_OF)
    return day_files.read_days(spark, "journeys", str(tmp_path / "journeys"))


def test_window_prunes_days_and_columns(spark, tmp_path):
    journeys = stored_journeys(spark, tmp_path)
    text = plan(coverage.missing_share(journeys, st.AS_OF, 400, by_journey=False))
    assert re.search(r"PartitionFilters: \[isnotnull\(operating_day#\d+\), \(operating_day#\d+ >= 2000-06-27\), \(operating_day#\d+ <= 2001-08-01\)\]", text)
    assert "ReadSchema: struct<has_realtime:boolean,line_short:string>" in text


def test_bundle_filter_reaches_the_line_scan(spark, tmp_path):
    st.lines(spark, SF_DIR).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    text = plan(bundles.journeys_of_bundle(stored_journeys(spark, tmp_path), lines, "Bündel 1"))
    assert "StringContains(bundle,Bündel 1)" in text
    assert "BroadcastHashJoin" in text
    # beyond the limits Spark's own choice stands
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        journeys = stored_journeys(spark, tmp_path)
        assert "BroadcastHashJoin" in plan(bundles.with_lines(journeys, lines))
        large = bundles.with_lines(journeys, lines, most_rows=3)
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        assert large.count() == bundles.with_lines(journeys, lines).count()
        assert "Broadcast" not in plan(bundles.if_small(lines, most_bytes=5).join(lines, "line"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reports_broadcast_their_lines_despite_join_estimates(spark):
    journeys, lines = st.journeys(spark, SF_DIR), st.lines(spark, SF_DIR)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(bundles.journeys_by_report(journeys, lines))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    orders = text[: text.index("orders.parquet")]
    assert "BroadcastHashJoin" in orders and "SortMergeJoin" not in orders


def test_coverage_shuffles_counts_only(spark):
    text = plan(coverage.operator_coverage(st.journeys(spark, SF_DIR), st.AS_OF))
    exchange = text.index("Exchange hashpartitioning(operator")
    assert "partial_count" in text[exchange:]
    counts = plan(coverage.incidents_by_day(
        bundles.with_lines(st.journeys(spark, SF_DIR), st.lines(spark, SF_DIR)), st.AS_OF, 35))
    assert counts.count("Exchange hashpartitioning") == 1


def test_next_stops_scan_and_shuffle_once(spark, tmp_path):
    columns = ("operating_day", "line_id", "journey_no", "idx", "station_no")
    st.stop_events(spark, SF_DIR).select(*columns).write.parquet(str(tmp_path / "stops"))
    stops = spark.read.parquet(str(tmp_path / "stops"))
    text = plan(segments.next_stops(stops, ("idx", "station_no")))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "IsNotNull(idx)" in text


def test_reports_meet_stations_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reports, stations = st.delay_reports(spark, SF_DIR), st.stations(spark, SF_DIR)
        text = plan(delays.reports_with_station_names(reports, stations))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["pivot_line_by_day", "pivot_line_by_day_weighted", "report_line_by_day"])
def test_pivots_filter_their_span_at_the_scan(spark, name):
    text = plan(QUERIES[name].build(spark, SF_DIR))
    # the days are dates of timestamps here, and the planner turns them round into a span of these
    assert re.search(r"DataFilters: \[.*o_orderdate#\d+ >= 2001-07-\d\d 00:00:00\)", text)
    assert re.search(r"o_orderdate#\d+ < 2001-08-0\d 00:00:00\)", text)


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(segments.one_row_per_stop(st.stop_reports(spark, SF_DIR), ("report_no", "report_size")))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_pivots_start_no_job(spark):
    journeys = bundles.with_lines(st.journeys(spark, SF_DIR), st.lines(spark, SF_DIR))
    rates = coverage.line_coverage_by_day(journeys, "2001-07-01", st.AS_OF)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    pivots.line_by_day(rates, days.last_days(st.AS_OF, 21))
    assert len(jobs.getJobIdsForGroup(None)) == before
