from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from punctua.functions import days, geo, incidents, match, numbers, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_line_ids(rows):
    df = rows("id string", [("de:X:1:2",), ("a:b",), (None,), ("",)])
    assert values(df, text.line_id_padded(F.col("id"))) == ["de:X:1", "a:b:", "", "::"]
    assert values(df, text.line_id_prefix(F.col("id"))) == ["de:X:1", "a:b", None, ""]


def test_client_ids(rows):
    df = rows("id string", [("a#b#c#d",), ("a#b",), (None,), ("a#b#",)])
    assert values(df, text.client_id(F.col("id"))) == ["c", "-", "-", ""]


def test_flags_and_numbers(rows):
    df = rows("t string", [("True",), ("false",), ("",), (None,), ("3",), ("3.5",), ("n/a",)])
    assert values(df, numbers.flag(F.col("t"))) == [True] + [False] * 6
    assert values(df, numbers.number_or_null(F.col("t"))) == [None] * 4 + [3.0, 3.5, None]
    assert values(df, numbers.int_or_null(F.col("t")))[4] == 3
    assert values(df, numbers.reported_flag(F.col("t"))) == [True, True, False, False, True, True, True]
    both = numbers.cancelled_any(F.lit(None).cast("boolean"), F.col("t") == "3")
    assert values(df, both) == [False, False, False, False, True, False, False]


def test_clock_text(rows):
    df = rows("t string", [("20240110063059",), ("2024011006",), ("20240110063",), ("",), (None,)])
    assert values(df, text.clock_text(F.col("t"))) == ["06:30", "", "06:3", "", ""]


def test_labels(rows):
    names = ["Neustadt Am Kanalufer", "Hauptbahnhof", "Ort ", " Markt", "", "A B C D E F G"]
    df = rows("i int, n string", [(i, n) for i, n in zip((1, 12, 123, 5, 6, 7), names)])

    def expected(name):
        head, _, tail = name.partition(" ")
        return (tail or head)[:8]

    assert values(df, text.stop_label(F.col("n"))) == [expected(n) for n in names]
    labels = values(df, text.indexed_stop_label(F.col("i"), F.col("n")))
    assert labels[:3] == ["01 Am Kanal", "12 Hauptbah", "123 Ort"]


def test_slug(rows):
    df = rows("n string", [("Bündel Süd",), ("ÄÖÜ ß",), ("plain",)])
    assert values(df, text.slug(F.col("n"))) == ["buendel_sued", "aeoeue_ss", "plain"]
    assert values(df, text.transliterate(F.col("n")))[1] == "AeOeUe ss"


def test_letter_code(rows):
    df = rows("n string", [("ab",), ("Zü 1",), ("ß",)])
    # z = 25, u = 20, e = 4
    assert values(df, text.letter_code(F.col("n"))) == ["1001", "1049", "1000"]


def test_complement_percent(rows):
    shares = [0.0, 1.0, 0.123, 0.5, -1.0, 2 / 3]
    df = rows("s double", [(s,) for s in shares])

    def expected(s):
        return str(int((1 - s) * 1000) / 10) + "%" if int(s) != -1 else "-"

    assert values(df, text.complement_percent(F.col("s"))) == [expected(s) for s in shares]


def test_display_text(rows):
    df = text.display_text(rows("a int, `2024-01-01` double", [(1, None), (None, 0.5)]))
    assert [tuple(r) for r in df.collect()] == [("1", "-"), ("-", "0.5")]


def test_rounding_follows_scaled_doubles(rows):
    pairs = [(k, n) for n in range(1, 121) for k in range(n + 1)]
    df = rows("k int, n int", pairs)
    got = df.select(numbers.round_scaled(numbers.ratio(F.col("k"), F.col("n")), 2)).collect()
    for (k, n), (value,) in zip(pairs, got):
        scaled = k / n * 100
        assert value == math.floor(scaled + 0.5) / 100, (k, n)


def test_ratio_of_zero(rows):
    df = rows("k int, n int", [(1, 0), (0, 0), (1, 2)])
    assert values(df, numbers.ratio(F.col("k"), F.col("n"))) == [None, None, 0.5]
    assert values(df, numbers.one_if_zero(F.col("n"))) == [1, 1, 2]


def test_times(rows, spark):
    df = rows("t string", [("2024-03-31T02:30:00+02:00",), ("2024-01-10T23:59:59+01:00",), ("",), (None,)])
    assert values(df, days.day_of(F.col("t"))) == [dt.date(2024, 3, 31), dt.date(2024, 1, 10), None, None]
    assert values(df, days.wall_time(F.col("t")))[1] == dt.datetime(2024, 1, 10, 23, 59, 59)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_local_text_ignores_session_zone(spark, rows, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = ["2024-07-01T10:00:00Z", "2024-01-01T10:00:00.000Z", "2024-10-27T00:30:00Z", "2024-10-27T01:30:00Z"]
        df = rows("t string", [(t,) for t in stamps])
        got = values(df, days.local_text(F.try_to_timestamp("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-07-01 12:00:00", "2024-01-01 11:00:00", "2024-10-27 02:30:00", "2024-10-27 02:30:00"]


def test_day_windows(rows):
    df = rows("d date", [(dt.date(2024, 3, n),) for n in (1, 2, 3)] + [(dt.date(2024, 2, 29),), (None,)])
    d = F.col("d")
    assert df.where(days.in_last_days(d, "2024-03-03", 1)).count() == 2
    assert df.where(days.in_last_days(d, "2024-03-03", 1, strict=True)).count() == 1
    # later days do not count
    assert df.where(days.in_last_days(d, "2024-03-01", 1)).count() == 2
    assert df.where(days.in_last_days(d, "2024-03-01", 1, strict=True)).count() == 1
    assert df.where(days.on_day(d, dt.date(2024, 3, 3), 2)).count() == 1
    assert df.where(days.in_previous_month(d, "2024-03-15")).count() == 1
    assert days.previous_month("2024-01-31") == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert days.last_days("2024-03-01", 2) == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_full_match_and_lists(rows):
    df = rows("v string", [("de:X:630:",), ("de:X:63",), (None,), ("630\n",)])
    assert df.where(match.full_match(F.col("v"), ".*(630|670).*")).count() == 1
    assert df.where(match.full_match(F.col("v"), "630")).count() == 0
    assert df.where(match.none_of(F.col("v"), ("de:X:63",))).count() == 2


def contract_form(group, rate, missing):
    if group != "1_2" or rate >= 0.85:
        return 0
    return min(int((1 - 0.05 - rate) * 10), missing)


def virtual_form(group, rate, total, missing):
    if group == "3" and rate < 0.75:
        return min(int((1 - 0.15 - rate) * 10), total)
    return contract_form(group, rate, missing)


def test_incident_forms(rows):
    cases = [(g, k, n) for g in ("1_2", "3", "Stadt") for n in range(1, 61) for k in range(n + 1)]
    df = rows("g string, k int, n int", cases)
    rate = numbers.ratio(F.col("k"), F.col("n"))
    got = df.select(
        incidents.contract_incidents(F.col("g"), rate, F.col("n") - F.col("k")),
        incidents.virtual_incidents(F.col("g"), rate, F.col("n"), F.col("n") - F.col("k")),
        incidents.report_incidents(F.lit("ebene_1_2"), incidents.float_rate(F.col("k"), F.col("n"))),
    ).collect()
    for (g, k, n), (contract, virtual, report) in zip(cases, got):
        assert contract == contract_form(g, k / n, n - k)
        assert virtual == virtual_form(g, k / n, n, n - k)
        assert report >= 0


def test_report_form_rounds_half_to_even(rows):
    # rates 0.10 and 0.15 lie half a tenth off; the contract form cuts them off
    df = rows("k int, n int", [(1, 10), (3, 20), (1, 20), (17, 20), (0, 5)])
    got = values(df, incidents.report_incidents(F.lit("ebene_1_2"), incidents.float_rate(F.col("k"), F.col("n"))))
    assert got == [8, 8, 9, 0, 10]


def snyder(lat, lon):
    """UTM 32N by the power series of Snyder's manual, as a second method."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, dl = math.radians(lat), math.radians(lon - 9)
    n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, s = math.tan(p) ** 2, ep2 * math.cos(p) ** 2, dl * math.cos(p)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p)
        - (35 * e2**3 / 3072) * math.sin(6 * p)
    )
    east = 500000 + k0 * n * (s + (1 - t + c) * s**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * s**5 / 120)
    north = k0 * (m + n * math.tan(p) * (s * s / 2 + (5 - t + 9 * c + 4 * c * c) * s**4 / 24
                                         + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * s**6 / 720))
    return east, north


def test_projection_against_second_method(rows):
    points = [(la, lo) for la in (47.5, 50.0, 53.08, 54.9) for lo in (6.5, 8.8, 9.0, 11.2)]
    df = rows("lat double, lon double", points)
    xi, eta = geo.transverse_sphere(F.col("lat"), F.col("lon"))
    flat = df.select("lat", "lon", xi.alias("xi"), eta.alias("eta"))
    east, north = geo.krueger_metres(F.col("xi"), F.col("eta"))
    for (lat, lon), (e, n) in zip(points, flat.select(east, north).collect()):
        want_e, want_n = snyder(lat, lon)
        assert abs(e - want_e) < 0.05 and abs(n - want_n) < 0.05, (lat, lon)


def test_speeds(rows):
    df = rows("m int, s int", [(1001, 0), (1000, 0), (0, 0), (500, 60), (500, None)])
    got = values(df, geo.plausible_speed(F.col("m"), F.col("s")))
    assert got == [999.0, 1.0, 1.0, 500 / 60 * 3.6, None]


def test_scheduled_seconds_wrap(rows):
    t = dt.datetime
    df = rows(
        "a timestamp_ntz, b timestamp_ntz",
        [(t(2024, 1, 1, 23, 59), t(2024, 1, 2, 0, 1)), (t(2024, 1, 1, 12), t(2024, 1, 1, 11, 58)), (t(2024, 1, 1), None)],
    )
    assert values(df, geo.scheduled_seconds(F.col("a"), F.col("b"))) == [120, 86280, None]
