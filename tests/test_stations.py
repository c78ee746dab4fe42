"""Names of stations over time."""

from __future__ import annotations

import datetime as dt
import random

from punctua.operators import stations

CALLS = "operating_day date, station_no string, station_name string, lat double, lon double"
REPORTS = """operating_day date, line_id string, journey_no string, station_no int, station_name string,
    sched_dep string, reported_at string"""


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_intervals(rows):
    data = [
        (day(0), "1", "A", 1.0, 1.0), (day(0), "1", "A", 1.0, 1.0), (day(0), "1", "B", 1.0, 1.0),
        (day(2), "1", "A", 1.0, 1.0), (day(5), "1", "B", 1.0, 1.0), (day(9), "1", "B", 2.0, 1.0),
        (day(10), "1", "A", 1.0, 1.0), (day(3), "2", None, None, None), (day(4), "2", "C", 0.0, 0.0),
        (None, "1", "X", 1.0, 1.0), (day(1), None, "Y", 1.0, 1.0),
    ]
    got = {tuple(r) for r in stations.station_intervals(rows(CALLS, data)).collect()}
    assert got == {
        ("1", "A", 1.0, 1.0, None, day(4)), ("1", "B", 1.0, 1.0, day(5), day(8)),
        ("1", "B", 2.0, 1.0, day(9), day(9)), ("1", "A", 1.0, 1.0, day(10), None),
        ("2", None, None, None, None, day(3)), ("2", "C", 0.0, 0.0, day(4), None),
    }
    names = {tuple(r) for r in stations.station_intervals(rows(CALLS, data), ("station_name",)).collect()}
    assert ("1", "B", day(5), day(9)) in names and len(names) == 5
    # equal numbers of calls: the first name in order, whatever the order of the rows
    tie = [(day(0), "1", n, 1.0, 1.0) for n in ("B", "A")]
    assert [r.station_name for r in stations.station_intervals(rows(CALLS, tie)).collect()] == ["A"]
    assert stations.station_intervals(rows(CALLS, [])).collect() == []


def test_one_row_per_report_with_the_name_of_its_day(rows):
    random.seed(4)
    calls = [(day(random.randrange(60)), str(s), random.choice("AB"), 0.0, 0.0) for s in range(5) for _ in range(40)]
    reports = [
        (day(random.randrange(-5, 70)) if i % 11 else None, "l", str(i), random.randrange(7), "old", "x" if i % 7 else "", "t")
        for i in range(300)
    ]
    named = stations.reports_with_names_of_day(
        rows(REPORTS, reports), stations.station_intervals(rows(CALLS, calls)), ordered=True
    )
    got = {r.journey_no: r.station_name for r in named.collect()}
    wanted = {}
    for d, _, no, station, _, sched, _ in reports:
        if not sched:
            continue
        by_day = {}
        for c in calls:
            if c[1] == str(station):
                by_day.setdefault(c[0], []).append(c[2])
        best = {k: min(set(v), key=lambda n: (-v.count(n), n)) for k, v in by_day.items()}
        upto = [k for k in best if d is not None and k <= d] or ([min(best)] if best and d is not None else [])
        wanted[no] = best[max(upto)] if upto else None
    assert named.count() == len(wanted) and got == wanted
