from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctua.functions import days
from punctua.operators import bundles, coverage, delays, extras, listing, pivots, segments
from punctua.plans import bundle_report

D = dt.date


def test_bundle_match_modes(rows):
    lines = rows(
        "line string, bundle string, tier string, line_id_short string, id string",
        [("1", "OL", "1", "a", ""), ("2", "OL Stadt", "2", "b", ""), ("3", None, "3", "c", "")],
    )
    facts = rows("line_id_short string, n int", [("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)])
    part = bundles.with_lines(facts, lines.where(bundles.bundle_filter("OL", "contains")))
    whole = bundles.with_lines(facts, lines.where(bundles.bundle_filter("OL", "equals")))
    assert sorted(r.n for r in part.collect()) == [1, 2]
    assert [r.n for r in whole.collect()] == [1]
    with pytest.raises(ValueError):
        bundles.bundle_filter("OL", "like")


def test_nested_bundles_against_all_pairs(rows):
    names = ["OL", "OL Stadt", "Stadt", "HB", "HB Bus", "nahsh", "nahsh B", "a", "", "ß ü", "%", "_"]
    lines = rows(
        "line string, bundle string, tier string, line_id_short string, id string",
        [("1", n, "1", f"l{i}", "") for i, n in enumerate(names)] + [("9", None, "1", "l99", "")],
    )
    got = {tuple(r) for r in bundles.nested_bundles(lines).collect()}
    assert got == {(r, b) for r in names if r != "nahsh" for b in names if r in b}
    # only windows of the lengths that reported names have
    lengths = {len(n) for n in names if n != "nahsh"}
    spread = bundles.spread_names(lines, list(lengths)).groupBy("bundle").count().collect()
    assert all(r["count"] <= max(1, len(r.bundle)) * len(lengths) for r in spread)
    assert sum(r["count"] for r in bundles.spread_names(lines, [2]).groupBy("bundle").count().collect()) < 40
    plan = bundles.nested_bundles(lines)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_operator_coverage_of_unnamed_group(rows):
    journeys = rows(
        "operating_day date, operator string, ever_reported boolean",
        [(D(2024, 1, 9), "A", True), (D(2024, 1, 9), "A", False), (D(2024, 1, 8), None, True), (D(2024, 1, 1), "B", None)],
    )
    got = {r.operator: r for r in coverage.operator_coverage(journeys, "2024-01-10").collect()}
    assert (got["A"].total, got["A"].total_rt, got["A"].day_1_percent) == (2, 1, 50.0)
    assert (got[None].total, got[None].day_2_total) == (0, 0)
    # no journey on a day: no percentage rather than an error
    assert got["B"].day_1_percent is None and got["B"].total_rt == 0


def test_missing_and_covered_add_up(rows):
    random.seed(5)
    data = [
        (D(2024, 1, 1 + random.randrange(20)), f"L{random.randrange(4)}", f"J{random.randrange(9)}", "x:1",
         random.random() < 0.6, "1", random.random() < 0.8)
        for _ in range(500)
    ]
    schema = "operating_day date, line_short string, journey_no string, line_id string, has_realtime boolean, tier string, ever_reported boolean"
    journeys = rows(schema, data)
    got = coverage.incomplete_journeys(journeys, "2024-01-21", 30).collect()
    for r in got:
        chosen = [d for d in data if d[1] == r.line_short and d[2] == r.journey_no]
        assert r.missing + r.total_rt == r.total == len(chosen)
        assert r.last_delivery == max((d[0] for d in chosen if d[4]), default=None)
    assert coverage.missing_share(journeys, "2024-01-21", by_journey=False).count() == 4
    assert coverage.missing_share(journeys, "2024-01-21", pattern="x:2").count() == 0


def test_pivot_refuses_duplicates(spark, rows):
    rates = rows("day string, bundle string, percent_rt double", [("2024-01-01", "A", 1.0), ("2024-01-02", "B", 2.0)])
    got = pivots.day_by_bundle(rates, ["A", "B"])
    assert [tuple(r) for r in got.collect()] == [("2024-01-02", None, 2.0), ("2024-01-01", 1.0, None)]
    with pytest.raises(Exception, match="more than one value"):
        pivots.day_by_bundle(rates.union(rates), ["A", "B"]).collect()


def test_line_pivot_adds_rates_of_same_name(rows):
    rates = rows(
        "operating_day date, tier string, line_short string, rate double, total int, total_rt int",
        [(D(2024, 1, 1), "1", "S1", 1.0, 1, 1), (D(2024, 1, 1), "1", "S1", 0.5, 3, 1), (D(2024, 1, 2), "1", "S1", 0.5, 2, 1)],
    )
    columns = ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert tuple(pivots.line_by_day(rates, columns).first()) == ("1", "S1", 1.5, 0.5, None)
    assert tuple(pivots.weighted_line_by_day(rates, columns).first()) == ("1", "S1", 0.5, 0.5, None)


def test_total_rows(rows):
    table = rows("b string, day string, g string, total int, incidents int", [("x", "1", "p", 5, 2), ("x", "2", "p", 6, 3), ("y", "1", "p", 7, 4)])
    got = pivots.with_total_row(table, ("day", "g"), "incidents", ("b",)).collect()
    totals = {r.b: r for r in got if r.is_total}
    assert len(got) == 5 and totals["x"].incidents == 5 and totals["y"].incidents == 4
    assert totals["x"].day is None and totals["x"].total is None


def journeys_and_extras(rows):
    random.seed(3)

    def pick(n):
        return [
            (D(2024, 1, random.randrange(1, 4)), random.choice(["", None, "7", "8", "9"]), random.choice(["S1", "S2", None]))
            for _ in range(n)
        ]

    left = pick(40)
    right = [(*r, "l:1", random.choice(["Bus", None])) for r in pick(30)]
    missing = rows("operating_day date, journey_no string, line_short string", left)
    extra = rows("operating_day date, journey_no string, line_short string, line_id string, operator string", right)
    return left, right, missing, extra


def test_match_extras_as_pandas_merges(rows):
    left, right, missing, extra = journeys_and_extras(rows)
    pl = pd.DataFrame(left, columns=["day", "no", "line"])
    pr = pd.DataFrame(right, columns=["day", "no", "line", "id", "op"])
    merged = pl.merge(pr, on=["day", "no"], how="left")
    assert extras.match_extras(missing, extra, null_safe=True).count() == len(merged)
    plain = extras.match_extras(missing, extra)
    unmatched_null = merged[merged.no.isnull()].shape[0] - pl[pl.no.isnull()].shape[0]
    assert plain.count() == len(merged) - unmatched_null
    matched = extras.only_matched(plain)
    assert matched.where("extra_operator is null").count() == 0
    assert matched.count() == merged[merged.no.notnull() & merged.op.notnull()].shape[0]


def test_missing_days_count_the_fan_out(rows):
    left, right, missing, extra = journeys_and_extras(rows)
    want = Counter()
    span = {}
    for day, no, line in left:
        if no is None or line is None:
            continue
        want[line, no] += max(1, sum(1 for r in right if r[0] == day and r[1] == no))
        first, last = span.get((line, no), (day, day))
        span[line, no] = (min(first, day), max(last, day))
    got = extras.missing_days_per_journey(missing, extra).collect()
    assert {(r.line_short, r.journey_no): r.days_missing for r in got} == dict(want)
    assert {(r.line_short, r.journey_no): (r.first_day, r.last_day) for r in got} == span


def test_extra_pattern_is_a_whole_match(rows):
    extra = rows(
        "operating_day date, line_short string, line_id string, journey_no string, operator string",
        [(D(2024, 1, 1), "S", "de:X:630:", "1", "a")] * 2 + [(D(2024, 1, 1), "S", "xde:X:630:", "1", "a"), (D(2023, 1, 1), "S", "de:X:630:", "1", "a")],
    )
    assert extras.extra_journeys(extra, "2024-01-10", 30, "de:X:.*(630|670).*").count() == 1


def stop_rows(rows, data):
    """(day, journey_no, idx, dep_delay) as stop events of one line."""
    return rows(
        "operating_day date, line_id string, line_short string, journey_no string, idx int, dep_delay double, has_rt boolean",
        [(day, "de:NET:610:1", "610", no, idx, delay, True) for day, no, idx, delay in data],
    )


def test_flat_zero(rows):
    data = []
    for n in range(1, 7):
        data += [(D(2024, 1, n), "zeros", 1, 0.0), (D(2024, 1, n), "zeros", 2, 0.0), (D(2024, 1, n), "zeros", 3, None)]
        data += [(D(2024, 1, n), "cancels", 1, 1.0), (D(2024, 1, n), "cancels", 2, -1.0)]
        data += [(D(2024, 1, n), "late", 1, 1.0), (D(2024, 1, n), "late", 2, 0.0)]
    stops = stop_rows(rows, data)
    mean = delays.flat_zero_journeys(stops, "2024-01-07", 28, "de:NET:6__:%").collect()
    assert {r.journey_no: r.days for r in mean} == {"zeros": 6, "cancels": 6}
    strict = delays.flat_zero_journeys(stops, "2024-01-07", 28, strict_zero=True).collect()
    assert [(r.journey_no, r.first_day, r.last_day) for r in strict] == [("zeros", D(2024, 1, 1), D(2024, 1, 6))]
    # the first day of the window is left out; three days are not enough
    assert delays.flat_zero_journeys(stops, "2024-01-07", 4).count() == 0
    assert delays.flat_zero_journeys(stops, "2024-01-07", 5).count() == 2
    assert delays.flat_zero_journeys(stops, "2024-01-07", 28, "de:NET:7__:%").count() == 0


def test_boxplot_against_numpy(rows):
    rng = np.random.default_rng(11)
    samples = {n: rng.integers(-3, 29, size=n).astype(float) for n in (1, 2, 3, 7, 50)}
    samples[99] = np.array([0.0] * 20 + [25.0, -9.0])
    data = [(D(2024, 1, 1), str(n), 1, float(v)) for n, vs in samples.items() for v in vs]
    got = {r.journey_no: r for r in delays.boxplot(stop_rows(rows, data)).collect()}
    far = {}
    for n, vs in samples.items():
        q1, mid, q3 = np.percentile(vs, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = vs[(vs >= low) & (vs <= high)]
        r = got[str(n)]
        assert (r.n, r.q1, r.median, r.q3) == (len(vs), q1, mid, q3)
        assert (r.whisker_low, r.whisker_high) == (min(inside.min(), q1), max(inside.max(), q3))
        assert r.outliers == len(vs) - len(inside)
        far.update({(str(n), v): int((vs == v).sum()) for v in vs if v < low or v > high})
    out = delays.boxplot_outliers(stop_rows(rows, data)).collect()
    assert {(r.journey_no, r.dep_delay): r.n for r in out} == far


def test_plausible_delays_and_labels(rows):
    stops = rows(
        "operating_day date, line_short string, journey_no string, idx int, station_name string, dep_delay double",
        [
            (D(2024, 1, 1), "S", "1", 1, None, 0.0),
            (D(2024, 1, 2), "S", "1", 1, "Old Name", 29.9),
            (D(2024, 1, 3), "S", "1", 1, "New Name", 2.0),
            (D(2024, 1, 4), "S", "1", 1, "Late", 30.0),
            (D(2024, 1, 5), "S", "1", 1, "Unknown", None),
        ],
    )
    kept = delays.plausible_delays(stops, "2024-01-01", "2024-12-31", "S")
    assert kept.count() == 3
    assert delays.stop_labels(kept).first().station_name == "Old Name"
    last = delays.stop_labels(kept, "last").first()
    assert (last.station_name, last.label) == ("New Name", "01 Name")
    assert tuple(delays.journey_days(kept).first()) == ("S", "1", 3, D(2024, 1, 1), D(2024, 1, 3))


def test_reports_with_stops_keeps_rows_without_keys(rows):
    reports = rows(
        "operating_day date, line_short string, line_id string, journey_no string, station_name string, station_no int, sched_dep string, delay_arrival double, delay_departure double, stop_cancelled boolean, reported_at string",
        [(D(2024, 1, 1), "S", "l", "1", "A", 1, "x", 0.0, 0.0, False, "t1"), (D(2024, 1, 1), "S", "l", "1", "A", 1, "x", 0.0, 0.0, False, "t2"),
         (D(2024, 1, 1), "S", "l", None, "A", 1, "x", 0.0, 0.0, False, "t3"), (D(2024, 1, 1), "S", "l", "1", "B", 1, "x", 0.0, 0.0, False, "t4"),
         (D(2024, 1, 1), "S", "l", "1", "A", 1, "x", 0.0, 0.0, True, "t5"), (D(2024, 1, 1), "T", "l", "1", "A", 1, "x", 0.0, 0.0, False, "t6")],
    )
    stops = rows(
        "operating_day date, line_short string, journey_no string, station_name string, idx int, arr_delay double, dep_delay double",
        [(D(2024, 1, 1), "S", "1", "A", 3, 1.0, 2.0), (D(2024, 1, 1), "S", "1", "A", 9, 5.0, 6.0), (D(2024, 1, 1), "S", None, "A", 1, 0.0, 0.0)],
    )
    got = delays.reports_with_stops(reports, stops, "S", ordered=True).collect()
    # a station called at twice doubles its reports; unmatched reports stay
    assert Counter((r.reported_at, r.idx) for r in got) == Counter(
        [("t1", 3), ("t1", 9), ("t2", 3), ("t2", 9), ("t3", None), ("t4", None)]
    )
    assert delays.reports_with_stops(reports, stops).count() == 7
    # '' stands for a missing number, unless it is said to match
    reports, stops = (d.withColumn("journey_no", F.lit("")) for d in (reports, stops))
    assert delays.reports_with_stops(reports, stops, "S").where("idx is not null").count() == 0
    assert delays.reports_with_stops(reports, stops, "S", match_empty=True).where("idx is not null").count() == 9


def test_station_names_fan_out(rows):
    reports = rows("line_id string, journey_no string, reported_at string, station_no int, station_name string, sched_dep string",
                   [("l", "1", "t", 1, None, "x"), ("l", "1", "t", 2, None, "x"), ("l", "1", "t", 1, None, "")])
    stations = rows("station_no string, lat double, lon double, station_name string", [("1", 1.0, 1.0, "A"), ("1", 1.0, 2.0, "A"), ("1", 1.0, 1.0, "B")])
    got = delays.reports_with_station_names(reports, stations, ordered=True).collect()
    assert sorted((r.station_no, r.station_name or "") for r in got) == [(1, "A"), (1, "A"), (1, "B"), (2, "")]
    texts = reports.withColumn("station_no", F.lit("12"))
    two = rows("station_no string, station_name string", [("12", "A"), ("0012", "B")])
    assert {(r.station_no, r.station_name) for r in delays.reports_with_station_names(texts, two).collect()} == {(12, "A")}


def brute_next(data):
    groups = {}
    for day, line, no, idx, name in data:
        if no:
            groups.setdefault((day, line, no), []).append((idx, name))
    out = set()
    for key, stops in groups.items():
        stops.sort()
        out |= {(*key, a[0], b[0], b[1]) for a, b in zip(stops, stops[1:])}
    return out


def test_next_stops(rows):
    random.seed(5)
    data = []
    for day in (D(2024, 1, 1), D(2024, 1, 2)):
        for no in ("1", "2", "", None):
            for idx in random.sample(range(30), random.randrange(1, 20)):
                data.append((day, "l", no, idx, f"s{idx}"))
    stops = rows("operating_day date, line_id string, journey_no string, idx int, station_name string", data)
    got = segments.next_stops(stops, ("idx", "station_name"))
    assert {tuple(r) for r in got.select("operating_day", "line_id", "journey_no", "idx", "idx_next", "station_name_next").collect()} == brute_next(data)
    assert got.count() == len(brute_next(data))


def test_segments(rows):
    t = dt.datetime
    stops = rows(
        "operating_day date, line_id string, journey_no string, idx int, station_no string, station_name string, sched_dep timestamp_ntz, sched_arr timestamp_ntz, dep_delay double, arr_delay double, lat double, lon double",
        [
            (D(2024, 1, 1), "l", "1", 1, "a", "A", t(2024, 1, 1, 23, 58), None, 0.0, 1.0, 53.0, 9.0),
            (D(2024, 1, 1), "l", "1", 2, "b", "B", t(2024, 1, 2, 0, 2), t(2024, 1, 2, 0, 1), 0.0, 4.0, 53.01, 9.0),
            (D(2024, 1, 1), "l", "1", 3, "c", "C", t(2024, 1, 2, 0, 5), t(2024, 1, 2, 0, 2), 0.0, None, 53.02, 9.0),
            (D(2024, 1, 1), "l", "1", 4, "d", "D", None, t(2024, 1, 2, 0, 5), 0.0, 2.0, 53.0201, 9.0),
        ],
    )
    one, two, three = segments.segments(stops).orderBy("idx").collect()
    # 0.01 degrees along the meridian: about 1112.9 m, less the scale of 0.9996
    assert one.metres == 1112 and one.seconds == 180 and one.km_h == 1112 / 180 * 3.6 and one.delay_change == 3.0
    assert (two.seconds, two.km_h, two.delay_change) == (0, 999.0, None)
    assert (three.metres, three.seconds, three.km_h) == (11, 0, 1.0)


def test_one_row_per_stop(rows):
    stops = rows(
        "operating_day date, line_id string, journey_no string, idx int, v int",
        [(D(2024, 1, 1), "l", "1", 1, v) for v in (5, 3, 4)] + [(D(2024, 1, 1), "l", "1", 2, 9)],
    )
    got = segments.one_row_per_stop(stops, ("v",))
    assert got.columns == stops.columns
    assert sorted((r.idx, r.v) for r in got.collect()) == [(1, 3), (2, 9)]
    # stops without a journey number may be of many journeys: none is taken for a copy
    loose = rows(
        "operating_day date, line_id string, journey_no string, idx int, v int",
        [(D(2024, 1, 1), "l", no, 1, v) for no in ("", None) for v in (1, 2)],
    )
    assert segments.one_row_per_stop(loose, ("v",)).count() == 4
    assert segments.repeated_stops(loose).count() == 0


def test_repeated_stops_are_told_and_not_linked_to_each_other(rows):
    stops = rows(
        "operating_day date, line_id string, journey_no string, idx int, station_no string",
        [(D(2024, 1, 1), "l", "1", idx, s) for idx, s in ((1, "a"), (2, "b"), (2, "c"), (3, "d"))],
    )
    (told,) = segments.repeated_stops(stops).collect()
    assert (told.idx, told.rows) == (2, 2)
    got = segments.next_stops(stops, ("idx", "station_no")).collect()
    assert sorted((r.station_no, r.station_no_next) for r in got) == [("a", "b"), ("c", "d")]


def test_listing(rows):
    df = rows("a string, b int", [("x", 1), (None, 2), ("y", None), ("x", 3)])
    assert [tuple(r) for r in listing.sort(df, "a", "-b").collect()] == [("x", 3), ("x", 1), ("y", None), (None, 2)]
    assert [r.b for r in listing.sort(df, "-b").collect()] == [3, 2, 1, None]
    assert [tuple(r) for r in listing.first_rows(df, 1, "a", "b", skip=1).collect()] == [("x", 3)]
    assert [r.a for r in listing.sorted_distinct(df, "a").collect()] == ["x", "y", None]
    assert listing.star_with(df, led="a", twice=F.col("b") * 2).columns == ["led", "twice", "a", "b"]


def test_written_reports(spark, tmp_path):
    from conftest import SF_DIR

    from workload import standins as st

    journeys, stops, lines = st.journeys(spark, SF_DIR), st.stop_events(spark, SF_DIR), st.lines(spark, SF_DIR)
    extra = extras.extra_journeys(st.extras(spark, SF_DIR), st.AS_OF, 400)
    paths = bundle_report.write_bundle_reports(journeys, stops, lines, extra, str(tmp_path), st.AS_OF, 400, 400)
    assert set(paths) == {"incidents", "line_by_day", "incomplete", "extra_matches", "journeys", "stop_events"}
    written = spark.read.parquet(paths["journeys"])
    by_report = bundles.journeys_by_report(journeys, lines)
    recent = by_report.where(days.in_last_days(F.col("operating_day"), st.AS_OF, 400))
    assert written.count() == recent.count() > 0
    one = written.where("report_bundle = 'Bündel 1'")
    assert "PartitionFilters: [isnotnull(report_bundle" in one._jdf.queryExecution().executedPlan().toString()
    totals = spark.read.parquet(paths["incidents"]).where("is_total")
    assert totals.count() == spark.read.parquet(paths["incidents"]).select("report_bundle").distinct().count()


def test_segments_are_stops_less_journeys(spark):
    from conftest import SF_DIR

    from workload import standins as st

    stops = st.stop_events(spark, SF_DIR)
    journeys = stops.select(*segments.JOURNEY).distinct().count()
    assert segments.segments(stops).count() == stops.count() - journeys
