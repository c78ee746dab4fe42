"""Manifests, the ledger of served arrivals, accounting of files: probes of lost data."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from test_archive_xml import BARE, BROKEN, ENVELOPE, TAG, journeys_numbered

from punctua.__main__ import main
from punctua.operators import bundles, coverage
from punctua.plans import daily_ingest
from punctua.plans.daily_ingest import RejectedElements, ingest_archive, read_rejected
from punctua.sources import archive_xml as ax
from punctua.sources import day_files, deliveries
from punctua.streaming.ingest import UnclearArrivals


@pytest.fixture
def world(spark, tmp_path):
    """Landed files with a time each, and the jobs from the command line with default arguments."""

    class World:
        target = str(tmp_path / "tables")
        time = 1_700_000_000

        def put(self, place, *numbers, text=None, root="landed"):
            path = tmp_path / root / place
            path.parent.mkdir(parents=True, exist_ok=True)
            body = "\n".join(journeys_numbered(*numbers)) if text is None else text
            path.write_text(ENVELOPE.format(t=TAG, body=body), encoding="utf-8")
            World.time += 10
            os.utime(path, (World.time, World.time))
            return str(path)

        def serve(self, *more, root="landed"):
            main(["land", str(tmp_path / root), "--landing", str(tmp_path / "landing"), "--checkpoint", str(tmp_path / "progress")])
            return sorted(main(["serve", "--landing", str(tmp_path / "landing"), "--target", self.target, *more]))

        def ingest(self, path, day, *more):
            return main(["ingest", path, "--delivery-day", day, "--target", self.target, *more])

        def journeys(self, table="journeys"):
            found = day_files.read_days(spark, table, f"{self.target}/{table}")
            return sorted(r.journey_no for r in found.collect())

        def versions(self):
            return sorted(str(p) for p in Path(self.target).glob("*/version=*"))

    return World()


def test_a_correction_by_batch_stays_until_something_newer_lands(spark, world):
    world.put("2024-01-10/a.xml", 1, 2)
    assert world.serve() == ["2024-01-10"]
    world.ingest(world.put("fix.xml", 1, 2, 3, root="by-hand"), "2024-01-10")
    before = world.versions()
    assert world.serve() == [] and world.versions() == before  # no write job
    assert world.journeys() == ["1", "2", "3"]
    world.put("2024-01-10-b/a.xml", 1, 2, 4)
    assert world.serve() == ["2024-01-10"]
    assert world.journeys() == ["1", "2", "4"]
    rows = deliveries.ledger(spark, world.target).orderBy("number").collect()
    assert [(r.source, r.arrival, r.rows["journeys"]) for r in rows] == [
        ("stream", "2024-01-10", 2), ("batch", None, 3), ("stream", "2024-01-10-b", 3),
    ]
    assert len({r.digest for r in rows}) == 3


def test_an_old_file_loaded_again_by_hand_stays(world):
    old = world.put("old.xml", 9, root="by-hand")
    world.put("2024-01-10/a.xml", 1)
    world.serve()
    world.ingest(old, "2024-01-10")
    assert world.serve() == [] and world.journeys() == ["9"]


def test_the_same_content_again_is_noted_and_not_written(spark, world):
    world.put("2024-01-10/a.xml", 1, 2)
    world.serve()
    before = world.versions()
    world.put("2024-01-10-b/a.xml", 2, 1)
    assert world.serve() == [] and world.versions() == before
    assert deliveries.ledger(spark, world.target).count() == 2
    world.put("2024-01-11/a.xml", 5)
    assert world.serve() == ["2024-01-11"] and world.journeys() == ["1", "2", "5"]


@pytest.mark.parametrize("name", ["2024-01-10-extra", "2024-01-10-extras", "extra-2024-01-10", "extras_2024-01-10"])
def test_extras_stay_beside_the_main_delivery(world, name):
    world.put("2024-01-10/a.xml", 1, 2)
    world.put(f"{name}/a.xml", 9)
    assert world.serve() == ["2024-01-10"]
    assert world.serve("--extra") == ["2024-01-10"]
    assert world.journeys() == ["1", "2"] and world.journeys("extras") == ["9"]
    with pytest.raises(ValueError, match="extras alone"):
        world.serve("--extra", "--tables", "journeys")
    with pytest.raises(ValueError, match="extras alone"):
        world.serve("--tables", "extras")


def test_arrivals_that_need_not_be_one_delivery_are_refused(world):
    world.put("2024-01-10/a.xml", 1, 2)
    world.put("2024-01-10-zusatz/a.xml", 9)
    with pytest.raises(UnclearArrivals, match="zusatz"):
        world.serve()
    assert world.serve("--again-pattern", "(-zusatz)?") == ["2024-01-10"]
    assert world.journeys() == ["9"]


def test_the_day_is_looked_for_below_the_landed_folder(world):
    root = "run-2023-12-31-extra/landed"
    world.put("undated.xml", 1, root=root)
    (day,) = world.serve(root=root)
    assert day == "2023-11-14"  # the day of the file itself
    assert world.journeys() == ["1"]


def test_rejects_belong_to_the_tables_they_came_with(spark, world):
    bad = world.put("a.xml", text=BROKEN + BARE, root="by-hand")
    world.ingest(bad, "2024-01-10", "--allow-rejected")
    world.ingest(world.put("x.xml", 9, root="by-hand"), "2024-01-10", "--tables", "extras")
    assert [r.reason for r in read_rejected(spark, world.target).collect()] == ["does not parse"]
    world.ingest(world.put("a.xml", 7, root="again"), "2024-01-10", "--tables", "journeys")
    # stop events of the first job are still there, and so are its rejects
    assert read_rejected(spark, world.target).count() == 1
    done = world.ingest(world.put("a.xml", 7, 8, root="again"), "2024-01-10")
    assert read_rejected(spark, world.target).count() == 0
    assert done.rows == {"journeys": 2, "stop_events": 0, "journey_counts": 1, "rejected": 0, "accounts": 1}


def test_a_job_stopped_between_two_tables_leaves_the_old_delivery_whole(spark, world, monkeypatch):
    world.ingest(world.put("a.xml", 1, 2, root="by-hand"), "2024-01-10")

    def stopped(archive):
        raise KeyboardInterrupt

    monkeypatch.setitem(daily_ingest.FLATTEN, "stop_events", stopped)
    with pytest.raises(KeyboardInterrupt):
        world.ingest(world.put("b.xml", 3, root="by-hand"), "2024-01-10")
    assert world.journeys() == ["1", "2"]
    left = world.versions()
    gone = main(["expire", "--target", world.target])
    assert len(gone) == 3 and len(left) == 8  # journeys, rejected and accounts of the stopped job
    assert world.journeys() == ["1", "2"]


def test_nothing_recognised_replaces_nothing(spark, world):
    world.ingest(world.put("a.xml", 1, 2, 3, root="by-hand"), "2024-01-10")
    empty = Path(world.put("none.xml", text="<other/>", root="by-hand"))
    with pytest.raises(RejectedElements, match="1 elements"):
        world.ingest(str(empty), "2024-01-10")
    empty.write_text("")
    with pytest.raises(RejectedElements, match="1 elements"):
        world.ingest(str(empty), "2024-01-10")
    assert world.journeys() == ["1", "2", "3"]
    world.put("2024-01-10/a.xml", text="<other/>")
    with pytest.raises(RejectedElements):
        world.serve()
    assert world.journeys() == ["1", "2", "3"]


def test_prefixed_elements_are_read(spark, world):
    ns = BARE.replace("</", "</ns2:").replace(f"<{TAG}", f'<ns2:{TAG} xmlns:ns2="urn:x"')
    for name in ("journey", "operatingDay", "journeyID", "externalLineId", "destination"):
        ns = ns.replace(f"<{name}", f"<ns2:{name}")
    mixed = ns + BARE.replace(">7<", ">8<") + ns.replace(">7<", ">9<") + f"<ns2:{TAG}><ns2:journey>"
    done = world.ingest(world.put("a.xml", text=mixed, root="by-hand"), "2024-01-10", "--allow-rejected")
    assert world.journeys() == ["7", "8", "9"] and done.rows["rejected"] == 1
    (reject,) = read_rejected(spark, world.target).collect()
    assert reject.reason == "no end tag"


def test_files_are_accounted_for(spark, world):
    folder = str(Path(world.put("a.xml", 1, 2, root="by-hand")).parent)
    world.put("b.xml", text=BROKEN + BARE, root="by-hand")
    world.put("c.xml", text="", root="by-hand")
    (Path(folder) / "d.xml").write_text("")
    done = world.ingest(folder, "2024-01-10", "--allow-rejected")
    path = deliveries.side_paths(spark, world.target, deliveries.ACCOUNTS)
    rows = spark.read.parquet(f"{world.target}/{path[0]}").orderBy("source_file").collect()
    assert [(r.source_file[-5:], r.elements, r.used, r.rejected) for r in rows] == [
        ("a.xml", 2, 2, 0), ("b.xml", 2, 1, 1), ("c.xml", 0, 0, 0), ("d.xml", 0, 0, 0),
    ]
    assert done.rows == {"journeys": 3, "stop_events": 0, "journey_counts": 1, "rejected": 3, "accounts": 4}
    assert sorted(r.reason for r in read_rejected(spark, world.target).collect()) == [
        "does not parse", "no element", "no element",
    ]


def test_tables_stored_without_manifests_are_kept(spark, world, tmp_path):
    done = ingest_archive(spark, world.put("a.xml", 1, root="by-hand"), world.target, "2024-01-10", ("journeys",))
    rows = day_files.read_days(spark, "journeys", done["journeys"])
    older = str(tmp_path / "older" / "journeys")
    for day in ("2024-01-08", "2024-01-09"):
        rows.write.partitionBy("operating_day").parquet(f"{older}/delivery_day={day}")
    assert day_files.read_days(spark, "journeys", older).count() == 2
    day_files.write_days(rows.unionByName(rows), older, "2024-01-09")
    found = day_files.read_days(spark, "journeys", older, delivery_day=True).groupBy("delivery_day").count()
    assert sorted((str(r[0]), r[1]) for r in found.collect()) == [("2024-01-08", 1), ("2024-01-09", 2)]


def test_migration_refuses_a_folder_with_deliveries(spark, world, tmp_path):
    done = ingest_archive(spark, world.put("a.xml", 1, root="by-hand"), world.target, "2024-01-10", ("journeys",))
    rows = day_files.read_days(spark, "journeys", done["journeys"])
    rows.write.parquet(str(tmp_path / "old"))
    for target in (done["journeys"], str(tmp_path / "one")):
        if target != done["journeys"]:
            day_files.write_days(rows, target, "2024-01-10")
        with pytest.raises(ValueError, match="holds deliveries"):
            day_files.migrate_day_files(spark, "journeys", [str(tmp_path / "old")], target)
        assert day_files.read_days(spark, "journeys", target).count() == 1
    moved = day_files.migrate_day_files(spark, "journeys", [str(tmp_path / "old")], str(tmp_path / "new"))
    assert moved.count() == 1
    day_files.write_days(rows.unionByName(rows), str(tmp_path / "new"), "2024-01-11")
    assert day_files.read_days(spark, "journeys", str(tmp_path / "new")).count() == 2


def test_a_streams_own_elements_keep_their_print(spark):
    df = spark.createDataFrame([(BARE,), (None,)], "xml string")
    assert sorted(r.elements for r in ax.accounts(ax.parse_archive(df, "xml")).collect()) == [1]


def test_counts_of_replaced_deliveries_equal_a_scan(spark, world):
    """Three deliveries, each replaced once: sheets from counts are those from journeys, which they do not read."""
    lines = spark.createDataFrame([("b", "HB", "1", "a:b:", "7")], "line string, bundle string, tier string, line_id_short string, id string")
    for again in (0, 1):
        for n in range(3):
            day = f"2024-01-1{n}"
            texts = [t.replace("2024-01-11", f"2024-01-0{1 + (n + i + again) % 4}") for i, t in enumerate(journeys_numbered(*range(7 + again + n)))]
            texts = [t.replace("<destination/>", "<realtimeHasEverBeenReported>true</realtimeHasEverBeenReported>") if i % 3 else t for i, t in enumerate(texts)]
            world.ingest(world.put(f"{again}{n}.xml", text="".join(texts), root="by-hand"), day, "--tables", "journeys")
    root = world.target
    journeys = day_files.with_short_line_id(day_files.read_days(spark, "journeys", f"{root}/journeys"))
    counts = day_files.read_days(spark, "journey_counts", f"{root}/journey_counts")
    assert journeys.count() == 8 + 9 + 10
    for build in (
        lambda rows: coverage.bundle_coverage_by_day(rows, lines, ("1",), "2024-01-12"),
        lambda rows: coverage.incidents_by_day(bundles.with_lines(rows, lines), "2024-01-12"),
        lambda rows: coverage.contract_incidents_by_day(bundles.with_lines(rows, lines), "2024-01-12"),
        lambda rows: coverage.line_coverage_by_day(bundles.with_lines(rows, lines), "2024-01-01", "2024-01-12", "ever_reported"),
    ):
        added, scanned = build(counts), build(journeys)
        assert added.dtypes == scanned.dtypes and added.count() > 0
        assert sorted(map(str, added.collect())) == sorted(map(str, scanned.collect()))
        assert not any("/journeys/" in f for f in added.inputFiles())


def test_the_newest_delivery_of_a_journey_counts(spark, tmp_path):
    schema = "operating_day string, line_id string, journey_no string, destination string, delivery_day string"
    rows = spark.createDataFrame(
        [("2024-01-01", "l", "1", "old", "2024-01-02"), ("2024-01-01", "l", "1", "new", "2024-01-03"),
         ("2024-01-01", "l", "1", "new too", "2024-01-03"), ("2024-01-01", "l", "2", "only", "2024-01-02"),
         ("2024-01-01", None, "3", "a", "2024-01-02"), ("2024-01-01", None, "3", "b", "2024-01-03"),
         ("2024-01-01", "l", None, "x", "2024-01-02"), ("2024-01-01", "l", None, "x", "2024-01-03"),
         ("2024-01-01", "l", " ", "y", "2024-01-02")], schema,
    )
    newest = day_files.newest_rows(rows)
    assert sorted(r.destination for r in newest.collect()) == ["b", "new", "new too", "only", "x", "x", "y"]
    assert newest.columns == rows.columns and day_files.newest_rows(rows.limit(0)).count() == 0
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()
