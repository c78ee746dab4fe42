from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from punctua.plans.daily_ingest import RejectedElements, delay_matrix, ingest_archive, read_rejected
from punctua.sources import archive_xml as ax
from punctua.sources import day_files
from punctua.streaming.ingest import land_new_files, serve_deliveries

TAG = ax.ROW_TAG
FULL = f"""<{TAG} kind="x">
  <journey>
    <deviceId>net#veh#c7</deviceId><operatingDay>2024-01-10T00:00:00+01:00</operatingDay>
    <journeyID>1630018</journeyID><journeyOperator>Bus &amp; Co</journeyOperator>
    <externalLineId>de:X:630:1</externalLineId><lineShortName> 630 </lineShortName>
    <destination>Köln</destination><hasRealtime>true</hasRealtime>
    <realtimeHasEverBeenReported>TRUE</realtimeHasEverBeenReported><journeyRtType>SCHEDULED</journeyRtType>
    <journeyCancelled>false</journeyCancelled>
    <lastTimestampJourneyCancellationReported>2024-01-10T05:00:00+01:00</lastTimestampJourneyCancellationReported>
    <scheduleDepartureTime><scheduleTime>2024-01-10T23:55:00+01:00</scheduleTime></scheduleDepartureTime>
    <scheduleDepartureStation><stationName>A Markt</stationName><dhid>de:1</dhid></scheduleDepartureStation>
  </journey>
  <details><index>1</index><departureDelay><delay>2</delay></departureDelay>
    <station><latitude>53080000</latitude><longitude>8800000</longitude>
      <stationExternalNumber>4711</stationExternalNumber><stationName>A Markt</stationName></station>
    <scheduleDepartureTime><scheduleTime>2024-01-10T23:55:00+01:00</scheduleTime></scheduleDepartureTime>
    <cancelled>true</cancelled>
    <delays><scheduleDeparture>20240110235500</scheduleDeparture><stationExternalNumber>4711</stationExternalNumber>
      <delayDataSets><delayMinutesDeparture>1</delayMinutesDeparture><stopCancelled>false</stopCancelled>
        <timestamp>2024-01-10T22:50:00Z</timestamp></delayDataSets></delays></details>
  <details><index>2</index>
    <station><latitude>53090000</latitude><longitude>8810000</longitude>
      <stationExternalNumber>4712</stationExternalNumber></station>
    <scheduleArrivalTime><scheduleTime>2024-01-11T00:03:00+01:00</scheduleTime></scheduleArrivalTime></details>
  <delays><scheduleDeparture>20240110235500</scheduleDeparture><stationExternalNumber>4711</stationExternalNumber>
    <delayDataSets><delayMinutesDeparture></delayMinutesDeparture><delayMinutesArrival>0</delayMinutesArrival>
      <stopCancelled>true</stopCancelled><timestamp>2024-07-10T22:50:00Z</timestamp></delayDataSets>
    <delayDataSets><delayMinutesDeparture>-1</delayMinutesDeparture><stopCancelled>false</stopCancelled>
      <timestamp>2024-07-10T22:55:00Z</timestamp></delayDataSets></delays>
  <delays><stationExternalNumber>4712</stationExternalNumber>
    <delayDataSets><timestamp>2024-07-10T22:50:00Z</timestamp></delayDataSets></delays>
</{TAG}>"""
BARE = f"""<{TAG}><journey><operatingDay>2024-01-11T00:00:00+01:00</operatingDay><journeyID>7</journeyID>
<externalLineId>a:b</externalLineId><destination/></journey></{TAG}>"""
BROKEN = f"<{TAG}><journey><journeyID>9</journeyId></journey></{TAG}>"
ENVELOPE = (
    '<?xml version="1.0" encoding="UTF-8"?><soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/">'
    "<soap:Body><{t}List>\n{body}\n</{t}List></soap:Body></soap:Envelope>"
)


def journeys_numbered(*numbers):
    return [BARE.replace(">7<", f">{n}<") for n in numbers]


def write(tmp_path, *elements, name="a.xml"):
    folder = tmp_path / "xml"
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(ENVELOPE.format(t=TAG, body="\n".join(elements)), encoding="utf-8")
    return str(folder)


def test_journeys(spark, tmp_path):
    archive = ax.read_archive(spark, write(tmp_path, FULL, BARE))
    full, bare = ax.journeys_from_archive(archive).orderBy("operating_day").collect()
    assert full.operating_day == dt.date(2024, 1, 10)
    assert (full.operator, full.line_id_short, full.client_id) == ("Bus & Co", "de:X:630", "c7")
    assert (full.has_realtime, full.ever_reported) == (True, True)
    assert (full.reported_cancelled, full.journey_cancelled, full.cancelled_any) == (True, False, True)
    assert full.start_time == "2024-01-10T23:55:00+01:00" and full.start_station == "A Markt"
    assert full.end_time is None and full.destination == "Köln"
    # missing texts are empty, missing times and places are NULL, flags are false
    assert (bare.journey_no, bare.line_id_short, bare.operator, bare.client_id) == ("7", "a:b", "", "-")
    assert (bare.destination, bare.ts_reported_cancelled) == ("", "")
    assert not (bare.has_realtime or bare.cancelled_any) and bare.start_time is None


def test_stop_events(spark, tmp_path):
    archive = ax.read_archive(spark, write(tmp_path, FULL, BARE))
    first, second = ax.stop_events_from_archive(archive).orderBy("idx").collect()
    assert (first.line_short, first.idx, first.dep_delay, first.arr_delay) == ("630", 1, 2.0, None)
    assert first.sched_dep == dt.datetime(2024, 1, 10, 23, 55) and first.cancelled
    assert (first.lat, first.lon, first.station_no) == (53.08, 8.8, "4711")
    # nothing is carried over from the stop before
    assert (second.station_name, second.dep_delay, second.sched_dep) == ("-", None, None)
    assert second.sched_arr == dt.datetime(2024, 1, 11, 0, 3)


def test_delay_reports(spark, tmp_path):
    archive = ax.read_archive(spark, write(tmp_path, FULL, BARE))
    got = delay_matrix(archive).orderBy("reported_at").collect()
    # the group without a scheduled departure is dropped; both nesting depths count
    assert [r.reported_at for r in got] == ["2024-01-10 23:50:00", "2024-07-11 00:50:00", "2024-07-11 00:55:00"]
    assert [r.delay_departure for r in got] == [1.0, None, -1.0]
    assert [r.stop_cancelled for r in got] == [False, True, False]
    assert {r.station_name for r in got} == {"A Markt"}


def test_renamed_stations(spark, tmp_path):
    """A station that changes its name within the archive: one row a report, on request."""
    later = FULL.replace("2024-01-10T00:00", "2024-01-11T00:00").replace("<stationName>A Markt", "<stationName>B Markt")
    unnamed = FULL.replace("2024-01-10T00:00", "2024-01-12T00:00").replace("<stationName>A Markt</stationName>", "")
    folder = write(tmp_path, FULL, later, unnamed)
    archive = ax.read_archive(spark, folder)
    once = delay_matrix(archive, names_of_day=True)
    assert once.columns == delay_matrix(archive).columns
    names = {(r.operating_day.day, r.station_name): r["count"] for r in once.groupBy("operating_day", "station_name").count().collect()}
    a_day = sum(n for (day, _), n in names.items() if day == 10)
    assert names == {(10, "A Markt"): a_day, (11, "B Markt"): a_day, (12, "B Markt"): a_day}
    assert delay_matrix(archive).count() > 3 * a_day
    target = str(tmp_path / "named")
    stored = ingest_archive(spark, folder, target, "2024-01-12", ("delay_reports",), names_of_day=True)
    assert stored.rows["delay_reports"] == 3 * a_day


def test_every_start_tag_is_used_or_set_aside(spark, tmp_path):
    spaced = BARE.replace(f"</{TAG}>", f"</{TAG} >")
    cut_off = FULL[:900]
    undated = BARE.replace("2024-01-11T", "soon")
    other = f"<{TAG}Other><journey/></{TAG}Other>"
    folder = write(tmp_path, spaced, FULL, BROKEN, other, cut_off, BARE, undated, f"<{TAG}/>", f"<{TAG} a='1'></{TAG}>")
    (tmp_path / "xml" / "b.xml").write_text(BARE[:-5], encoding="utf-8")
    archive = ax.read_archive(spark, folder).cache()
    assert sorted(r.journey_no for r in ax.journeys_from_archive(archive).collect()) == ["1630018", "7", "7"]
    aside = ax.rejected(archive).collect()
    assert sorted(r.reason for r in aside) == [
        "does not parse", "no end tag", "no end tag", "no end tag", "no journey", "no operating day",
    ]
    assert {r.source_file.rsplit("/", 1)[1] for r in aside} == {"a.xml", "b.xml"}
    assert any("<journeyID>9</journeyId>" in r.record for r in aside)


def test_one_file_is_shared_by_tasks(spark, tmp_path):
    many = [BARE.replace(">7<", f">{n}<") for n in range(20000)]
    folder = write(tmp_path, *many)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        journeys = ax.journeys_from_archive(ax.read_archive(spark, folder))
        assert journeys.rdd.getNumPartitions() > 4
        assert journeys.agg(F.count_distinct("journey_no"), F.count("*")).first()[:] == (20000, 20000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ingest_replaces_only_its_delivery(spark, tmp_path):
    target = str(tmp_path / "tables")
    folder = write(tmp_path, FULL, BARE)
    tables = ("journeys", "stop_events", "delay_reports")
    paths = ingest_archive(spark, folder, target, "2024-01-12", tables)
    ingest_archive(spark, folder, target, "2024-01-12", ("journeys",))
    ingest_archive(spark, folder, target, "2024-01-13", ("journeys",))
    assert day_files.read_days(spark, "journeys", paths["journeys"]).count() == 4
    assert day_files.read_days(spark, "stop_events", paths["stop_events"]).count() == 2
    assert day_files.read_days(spark, "delay_reports", paths["delay_reports"]).count() == 3
    one = day_files.read_day(spark, "journeys", paths["journeys"], "2024-01-11")
    assert [r.journey_no for r in one.collect()] == ["7", "7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(operating_day" in plan


def test_rejects_stop_the_job_unless_allowed(spark, tmp_path):
    target, folder = str(tmp_path / "tables"), write(tmp_path, FULL, BROKEN)
    with pytest.raises(RejectedElements, match="1 elements of 2024-01-12"):
        ingest_archive(spark, folder, target, "2024-01-12", ("journeys",))
    assert not (tmp_path / "tables" / "journeys").exists()
    paths = ingest_archive(spark, folder, target, "2024-01-12", ("journeys",), allow_rejected=True)
    assert day_files.read_days(spark, "journeys", paths["journeys"]).count() == 1
    assert [r.reason for r in spark.read.parquet(paths["rejected"]).collect()] == ["does not parse"]


def test_stream_and_batch_share_a_table(spark, tmp_path):
    landing, progress, target = (str(tmp_path / n) for n in ("landing", "progress", "tables"))
    folder = write(tmp_path, FULL, BROKEN, name="export_2024-01-12.xml")
    land_new_files(spark, folder, landing, progress).awaitTermination()
    land_new_files(spark, folder, landing, progress).awaitTermination()
    serve = lambda: serve_deliveries(spark, landing, target, ("journeys", "delay_reports"), allow_rejected=True)
    assert serve() == ["2024-01-12"]
    read = lambda table: day_files.read_days(spark, table, f"{target}/{table}")
    assert read("journeys").count() == 1 and read("delay_reports").count() == 3
    ingest_archive(spark, write(tmp_path / "batch", BARE), target, "2024-01-14", ("journeys",))
    # the delivery comes again in another file, and a new one beside it
    write(tmp_path, FULL, BARE, name="export_2024-01-12_again.xml")
    write(tmp_path, BARE, name="export_2024-01-13.xml")
    land_new_files(spark, folder, landing, progress).awaitTermination()
    assert serve() == ["2024-01-12", "2024-01-13"]
    assert sorted(r.journey_no for r in read("journeys").collect()) == ["1630018", "7", "7", "7"]
    assert read_rejected(spark, target).count() == 0
    with pytest.raises(ValueError, match="stream"):
        day_files.write_days(read("journeys"), landing, "2024-01-12")


def test_landed_folders_are_served_whole(spark, tmp_path, caplog):
    """A day folder of two files, files of another day in both names, an -extra folder; then a redelivery."""
    from punctua.__main__ import main

    landed, landing, target = (str(tmp_path / n) for n in ("landed", "landing", "tables"))

    def put(folder, name, *numbers):
        place = tmp_path / "landed" / folder
        place.mkdir(parents=True, exist_ok=True)
        found = (BARE.replace(">7<", f">{n}<") for n in numbers)
        (place / name).write_text(ENVELOPE.format(t=TAG, body="\n".join(found)), encoding="utf-8")

    def served(table, *more):
        main(["land", landed, "--landing", landing, "--checkpoint", str(tmp_path / "progress")])
        main(["serve", "--landing", landing, "--target", target, "--tables", table, *more])
        return sorted(r.journey_no for r in day_files.read_days(spark, table, f"{target}/{table}").collect())

    put("2024-01-12", "a.xml", 1, 2)
    put("2024-01-12", "b.xml", 3)
    put("2024-01-13", "export_2024-01-13_a.xml", 4)
    put("2024-01-13/rest", "export_2024-01-13_b.xml", 5)
    put("2024-01-12-extra", "a.xml", 8)
    put("2024-01-12-extra", "b.xml", 9)
    assert served("journeys") == ["1", "2", "3", "4", "5"]
    assert served("extras", "--extra") == ["8", "9"]
    assert not caplog.records
    put("2024-01-12-again", "c.xml", 6)
    assert served("journeys") == ["4", "5", "6"]
    assert "2024-01-12: 1 older arrivals are left out" in caplog.text


def test_parts_named_by_a_day_need_an_arrival_pattern(spark, tmp_path):
    from punctua.__main__ import main

    landing, target = str(tmp_path / "landing"), str(tmp_path / "tables")
    for part in "ab":
        folder = write(tmp_path, BARE, name=f"export_2024-01-12_{part}.xml")
    pattern = r"(export_\d{4}-\d{2}-\d{2})_[a-z]\.xml$"
    main(["land", folder, "--landing", landing, "--checkpoint", str(tmp_path / "progress"), "--no-recursive", "--arrival-pattern", pattern])
    main(["serve", "--landing", landing, "--target", target, "--tables", "journeys"])
    assert day_files.read_days(spark, "journeys", f"{target}/journeys").count() == 2


def test_daily_jobs_from_the_command_line(spark, tmp_path):
    from punctua.__main__ import main

    folder, tables = write(tmp_path, FULL, BARE), str(tmp_path / "tables")
    main(["ingest", folder, "--delivery-day", "2024-01-12", "--target", tables, "--tables", "journeys", "extras", "stop_events", "delay_reports"])
    lines = tmp_path / "lines.csv"
    lines.write_text("linie;buendel;ebene;dlid;id\n630;HB;1;de:X:630;7\nx;HB Y;3;a:b:;8\n", encoding="utf-8")
    paths = main(["report", "--tables", tables, "--lines", str(lines), "--target", str(tmp_path / "out"), "--as-of", "2024-01-12"])
    journeys = spark.read.parquet(paths["journeys"]).collect()
    # the report of HB also takes the bundle whose name contains it
    assert sorted((r.report_bundle, r.journey_no) for r in journeys) == [("HB", "1630018"), ("HB", "7"), ("HB Y", "7")]
    stops = spark.read.parquet(paths["stop_events"])
    assert [r.idx for r in stops.orderBy("idx").collect()] == [1, 2]
    pivot = spark.read.parquet(paths["line_by_day"]).where("report_bundle = 'HB' and tier = '1'").first()
    assert pivot["2024-01-10"] == 1.0 and pivot["2024-01-12"] is None
    lists = main(["delays", "--tables", tables, "--target", str(tmp_path / "delays"), "--as-of", "2024-01-12", "--reports"])
    assert set(lists) == {"flat_zero", "boxplots", "repeated_stops", "segments", "reports_with_stops"}
    assert spark.read.parquet(lists["segments"]).count() == 1
    assert spark.read.parquet(lists["reports_with_stops"]).count() == 2
    targets = tmp_path / "targets.csv"
    targets.write_text("buen;project_url;folder_id\n'hb';'https://example.org/';12\n", encoding="utf-8")
    lists = main(["publish", "--lines", str(lines), "--targets", str(targets), "--target", str(tmp_path / "published")])
    assert [spark.read.parquet(lists[n]).count() for n in ("published", "unpublished")] == [1, 1]


ODD = [
    FULL,
    FULL.replace("<delay>2</delay>", "soon"),
    FULL.replace("<delay>2</delay>", "<delay>2</delay_>"),
    FULL.replace("<delay>2</delay>", "<delay><!-- none --><![CDATA[3]]></delay>"),
    FULL.replace("<departureDelay><delay>2</delay></departureDelay>", "<departureDelay/><departureDelay>1</departureDelay>"),
    FULL.replace("<index>1</index>", "<index><more>1</more></index>two"),
    FULL.replace("<delayDataSets><timestamp>", "<delayDataSets>x<timestamp>"),
    FULL.replace("<stationName>A Markt</stationName><dhid>", "<stationName>A & B</stationName><dhid>"),
    FULL.replace("<destination>Köln</destination>", "<destination><a>Köln</destination></a>"),
    FULL.replace("2024-01-10T00:00:00+01:00</operatingDay>", "soon</operatingDay>"),
    FULL.replace("journey>", "journeys>"),
]


@pytest.mark.parametrize("table", sorted(ax.PARTS))
def test_parts_of_an_element_give_the_same_table(spark, tmp_path, table):
    (tmp_path / "day.xml").write_text("<all>" + "".join(ODD) + "</all>")
    make = getattr(ax, f"{table}_from_archive")
    whole, parts = (make(ax.read_archive(spark, str(tmp_path), t)) for t in (None, table))
    assert parts.schema == whole.schema
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert whole.count() >= 2
    schema = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "destination" not in schema


def test_stored_stations_spare_the_matrix_a_parse(spark, tmp_path):
    (tmp_path / "day.xml").write_text("<all>" + "".join(ODD) + "</all>")
    archive = ax.read_archive(spark, str(tmp_path))
    ax.stations_from_archive(archive).write.parquet(str(tmp_path / "stations"))
    stored = spark.read.parquet(str(tmp_path / "stations"))
    named, again = delay_matrix(archive, stations=stored), delay_matrix(archive)
    assert sorted(map(str, named.collect())) == sorted(map(str, again.collect()))
    scans = [d._jdf.queryExecution().optimizedPlan().toString().count("from_xml") for d in (named, again)]
    assert scans[0] < scans[1]


def test_reading_keeps_methods_short_enough_to_be_compiled(spark, tmp_path):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    (tmp_path / "day.xml").write_text(FULL)
    try:
        spark.conf.set(key, "65535")
        ax.read_archive(spark, str(tmp_path))
        # the tests' session is built with the defaults, which count as not given
        assert spark.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, before)
