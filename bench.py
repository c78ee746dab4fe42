"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from punctua.session import build_session, clear_shared_folders
from workload import QUERIES, source_queries

HEADLINE = (
    "bundle_coverage_by_day",
    "operator_coverage",
    "incidents_by_day",
    "incident_forms",
    "incomplete_journeys",
    "missing_share_by_journey",
    "line_coverage_all_days",
    "pivot_line_by_day",
    "pivot_day_by_bundle",
    "matched_extras",
    "missing_days_per_journey",
    "nested_bundle_journeys",
    "report_incidents",
    "report_incomplete",
    "flat_zero_journeys",
    "reports_with_stops",
    "reports_with_station_names",
    "boxplot_per_stop",
    "next_stops",
    "segment_metrics",
    "local_report_times",
    "archive_journeys",
    "day_files_of_two_generations",
)


# Writes its own input (archive XML) while it is built: shown apart.
PREPARED = ("archive_journeys",)
# Old day files are written before the clock starts; their migration is timed.
INPUTS = {"day_files_of_two_generations": source_queries.old_day_files}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "punctua-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # starts the JVM's code paths once; not measured
    QUERIES["journey_count"].build(spark, sf_dir).collect()
    seconds, prepared = {}, {}
    for name in names:
        if name in INPUTS:
            start = time.perf_counter()
            INPUTS[name](spark, sf_dir)
            prepared[name] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()
        rows = QUERIES[name].build(spark, sf_dir)
        if name in PREPARED:
            prepared[name] = round(time.perf_counter() - start, 3)
            start = time.perf_counter()
        rows.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_shared_folders(spark)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "prepare": prepared,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
