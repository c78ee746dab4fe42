from __future__ import annotations

import datetime as dt
from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from punctua import schemas
from punctua.sources import catalog, day_files, master


def old_stop_events(index=(1, 2)):
    """A file as pandas writes it: nanoseconds, old names, nullable integers."""
    n = len(index)
    return pd.DataFrame(
        {
            "operday": pd.to_datetime(["2024-01-10"] * n),
            "journeyOperator": ["Bus"] * n,
            "ex_lineid": ["de:X:630:1"] * n,
            "fnr": ["1630018"] * n,
            "index": pd.array(index, dtype="Int32"),
            "has_rt": [True] * n,
            "dschedtime": pd.to_datetime(["2024-01-10 06:30:00"] + [None] * (n - 1)),
            "dep_del": [1.0] + [float("nan")] * (n - 1),
            "lat": [53.08] * n,
        }
    )


def test_pandas_nanoseconds_and_old_names(spark, tmp_path):
    frame = old_stop_events()
    assert str(frame["operday"].dtype) == "datetime64[ns]"
    frame.to_parquet(tmp_path / "verlauf_2024_01_10.parquet")
    got = day_files.read_day_files(spark, "stop_events", [f"{tmp_path}/verlauf*.parquet"])
    assert got.columns == schemas.struct("stop_events").fieldNames()
    first, second = got.orderBy("idx").collect()
    assert first.operating_day == dt.date(2024, 1, 10)
    assert first.sched_dep == dt.datetime(2024, 1, 10, 6, 30) and second.sched_dep is None
    assert (first.line_id, first.line_id_short) == ("de:X:630:1", "de:X:630")
    assert first.station_name is None and second.cancelled is None


def test_generations_of_files(spark, tmp_path):
    old = pd.DataFrame(
        {"datum": ["2024-01-10"], "fnr": ["1"], "lineid": ["a:b"], "journey_cancelled": [""], "hasRealtime": [True]}
    )
    new = pd.DataFrame(
        {"datum": pd.to_datetime(["2024-01-11"]), "fnr": ["2"], "lineid": ["a:b:c"], "journey_cancelled": [True]}
    )
    old.to_parquet(tmp_path / "zusatz_a.parquet")
    new.to_parquet(tmp_path / "zusatz_b.parquet")
    globs = [f"{tmp_path}/zusatz_a*", f"{tmp_path}/zusatz_b*"]
    got = day_files.read_day_files(spark, "extras", globs, source_file=True)
    rows = got.orderBy("operating_day").collect()
    assert [r.operating_day for r in rows] == [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
    assert [r.journey_cancelled for r in rows] == [None, True]
    assert [r.has_realtime for r in rows] == [True, None]
    assert [r.line_id_short for r in rows] == ["a:b:", "a:b:c"]
    assert [Path(r.source_file).name for r in rows] == ["zusatz_a.parquet", "zusatz_b.parquet"]


def test_missing_columns_inside_one_glob(spark, tmp_path):
    pd.DataFrame({"fnr": ["1"]}).to_parquet(tmp_path / "fahrten_a.parquet")
    pd.DataFrame({"fnr": ["2"], "vu": ["Bus"]}).to_parquet(tmp_path / "fahrten_b.parquet")
    got = day_files.read_day_files(spark, "journeys", [f"{tmp_path}/fahrten*.parquet"])
    assert {(r.journey_no, r.operator) for r in got.collect()} == {("1", None), ("2", "Bus")}


def test_large_day_is_split_and_small_days_are_not(spark, rows, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        big = spark.range(60000).select(
            F.lit("2024-01-10").cast("date").alias("operating_day"),
            F.sha2(F.col("id").cast("string"), 256).alias("line_id"),
        )
        small = spark.range(50).select(
            F.date_add(F.lit("2024-02-01").cast("date"), F.col("id").cast("int")).alias("operating_day"),
            F.lit("x").alias("line_id"),
        )
        target = str(tmp_path / "t")
        day_files.write_days(big.unionByName(small), target, "2024-03-01")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = lambda day: len(list(Path(target).glob(f"version=*/delivery_day=2024-03-01/operating_day={day}/*.parquet")))
    assert files("2024-01-10") > 1
    assert files("2024-02-03") == 1


def stored(spark, path):
    got = day_files.read_days(spark, "journeys", path, delivery_day=True)
    return sorted(((str(r.delivery_day), str(r.operating_day), r.journey_no) for r in got.collect()))


def journeys_of(spark, *days_and_numbers):
    data = [(dt.date.fromisoformat(d) if d else None, n) for d, n in days_and_numbers]
    return day_files.align(spark.createDataFrame(data, "operating_day date, journey_no string"), schemas.struct("journeys"))


def test_deliveries_leave_each_other_alone(spark, tmp_path):
    target = str(tmp_path / "t")
    first = journeys_of(spark, *[("2024-01-01", str(n)) for n in range(5)], (None, "x"))
    day_files.write_days(first, target, "2024-01-01")
    day_files.write_days(journeys_of(spark, ("2024-01-02", "6"), ("2024-01-01", "late"), (None, "y")), target, "2024-01-02")
    assert len(stored(spark, target)) == 9
    # the same delivery again, without the day it had: nothing of it is left over
    day_files.write_days(journeys_of(spark, ("2024-01-02", "7")), target, "2024-01-02")
    assert [r for r in stored(spark, target) if r[0] == "2024-01-02"] == [("2024-01-02", "2024-01-02", "7")]
    assert len(stored(spark, target)) == 7
    assert day_files.read_day(spark, "journeys", target, "2024-01-01").count() == 5


def test_migrated_days_prune(spark, tmp_path):
    for day in ("2024-01-10", "2024-01-11"):
        frame = pd.DataFrame({"datum": [day], "fnr": [day[-2:]], "lineid": ["a:b:c"]})
        frame.to_parquet(tmp_path / f"fahrten_{day}.parquet")
    pd.DataFrame({"datum": ["soon"], "fnr": ["x"], "lineid": ["a"]}).to_parquet(tmp_path / "fahrten_x.parquet")
    glob = f"{tmp_path}/fahrten*.parquet"
    for known in (None, {glob: "datum string, fnr string, lineid string"}):
        target = str(tmp_path / f"t{known is None}")
        got = day_files.migrate_day_files(spark, "journeys", [glob], target, known)
        assert sorted(r.journey_no for r in got.collect()) == ["10", "11", "x"]
        one = day_files.read_day(spark, "journeys", target, "2024-01-11")
        assert [r.journey_no for r in one.collect()] == ["11"]
        assert "PartitionFilters: [isnotnull(operating_day" in one._jdf.queryExecution().executedPlan().toString()


def raw_lines(rows):
    return rows(
        "nummer int, buendel string, ebene string, dlid string, id int, aktiv boolean",
        [(1, "A", "1", "x:1", 10, True), (2, None, "1", "x:2", 11, True), (3, "B", "3", "x:3", 12, False), (4, "B", "3", "x:4", 13, None)],
    )


def test_active_lines(rows):
    got = master.active_lines(raw_lines(rows), rt_operator=True)
    assert got.columns == ["line", "bundle", "rt_operator", "tier", "line_id_short", "id"]
    assert [tuple(r) for r in got.collect()] == [("1", "A", "", "1", "x:1", "10")]


def test_jdbc_reader_options(rows):
    """No database is started: the reader is a stand-in that records its options."""

    class Reader:
        def format(self, name):
            self.name = name
            return self

        def options(self, **options):
            self.given = options
            return self

        def load(self):
            return raw_lines(rows)

    class Session:
        read = Reader()

    lines = master.read_lines_jdbc(Session, "jdbc:postgresql://db/x", "some.lines", user="u")
    assert Session.read.name == "jdbc"
    assert Session.read.given == {"url": "jdbc:postgresql://db/x", "dbtable": "some.lines", "user": "u"}
    assert lines.count() == 1
    master.read_bundles_jdbc(Session, "jdbc:postgresql://db/x", "some.bundles")
    assert Session.read.given["dbtable"] == "some.bundles"


def test_csv_lists(spark, rows, tmp_path):
    (tmp_path / "lines.csv").write_text("linie;buendel;ebene;dlid;id\n630;HB;1+;de:X:630;7\n", encoding="utf-8")
    (line,) = master.read_lines_csv(spark, str(tmp_path / "lines.csv")).collect()
    assert tuple(line) == ("630", "HB", "1+", "de:X:630", "7")
    target = tmp_path / "targets.csv"
    target.write_text("buen;project_url;folder_id\n'a;b';'https://example.org/';12\n", encoding="utf-8")
    (row,) = master.read_publication_targets(spark, str(target)).collect()
    assert tuple(row) == ("a;b", "https://example.org/", 12)


def test_catalog(spark, rows, tmp_path):
    catalog.register(spark, some_lines=raw_lines(rows))
    assert "some_lines" in {r.tableName for r in catalog.list_tables(spark).collect()}
    described = {r.col_name: r.data_type for r in catalog.describe(spark, "some_lines").collect()}
    assert described["aktiv"] == "boolean" and len(described) == 6
    assert catalog.scan(spark, "some_lines").count() == 4
    stored = catalog.materialise(raw_lines(rows), str(tmp_path / "stored"))
    assert stored.count() == 4
