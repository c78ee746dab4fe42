"""Day tables clustered by journey: same results, no shuffle, and in step with the deliveries."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from punctua.__main__ import main
from punctua.operators import delays, extras, segments
from punctua.sources import clustered, day_files, deliveries
from workload import standins as st

BUCKETS = 5


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> Counter:
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables of two deliveries, some rows without a number, beside their clustered form."""
    root = str(tmp_path_factory.mktemp("clustered"))
    number = F.col("journey_no")
    number = F.when(number.endswith("7"), "").when(number.endswith("8"), None).otherwise(number)
    tables = {
        "stop_events": st.stop_events(spark, SF_DIR), "delay_reports": st.delay_reports(spark, SF_DIR),
        "journeys": st.journeys(spark, SF_DIR), "extras": st.extras(spark, SF_DIR),
    }
    lines = []
    for table, df in tables.items():
        own = F.concat("journey_no", F.lit("-"), F.dayofyear("operating_day"), F.right("journey_no", F.lit(1)))
        dated = df.withColumn("journey_no", own).withColumn("journey_no", number).withColumn("operating_day", F.trunc("operating_day", "year"))
        for day, part in (("2001-07-30", dated.where("line_short > 'L2'")), ("2001-07-31", dated.where("line_short <= 'L2'"))):
            below = f"{table}/version={deliveries.new_version()}/delivery_day={day}"
            day_files.write_version(day_files.align(part, day_files.struct(table)), f"{root}/{below}", ("operating_day",))
            lines.append(deliveries.Publication(day, {table: below}))
    deliveries.publish(spark, root, lines)
    for table in tables:
        assert clustered.cluster_days(spark, root, table, BUCKETS) == ["2001-07-30", "2001-07-31"]
    plain = {t: day_files.read_days(spark, t, f"{root}/{t}") for t in tables}
    near = {t: clustered.read_clustered(spark, root, t, BUCKETS) for t in tables}
    yield plain, near
    spark.conf.unset(clustered.CO_PARTITION)


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_same_rows(stored):
    plain, near = stored
    for table in plain:
        assert rows_of(near[table].select(*plain[table].columns)) == rows_of(plain[table])


def test_next_stops_without_a_shuffle(stored):
    plain, near = stored
    got = segments.next_stops(near["stop_events"], ("idx", "station_no"))
    wanted = segments.next_stops(plain["stop_events"], ("idx", "station_no"))
    assert "Exchange" not in plan(got) and "Exchange" in plan(wanted)
    assert rows_of(got.select(*wanted.columns)) == rows_of(wanted)
    assert wanted.count() > 1000


def test_reports_meet_stops_without_a_shuffle(stored):
    plain, near = stored
    got = delays.reports_with_stops(near["delay_reports"], near["stop_events"])
    wanted = delays.reports_with_stops(plain["delay_reports"], plain["stop_events"])
    assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got)
    assert got.columns == wanted.columns and rows_of(got) == rows_of(wanted)
    with pytest.raises(ValueError):
        delays.reports_with_stops(near["delay_reports"], near["stop_events"], match_empty=True)


def test_extras_meet_missing_journeys_without_a_shuffle(stored):
    def built(tables):
        bundled = tables["journeys"].withColumn("tier", F.lit("1"))
        missing = extras.without_realtime(bundled.where("journey_no <> ''"), st.AS_OF, st.WHOLE_SPAN)
        return extras.missing_days_per_journey(missing, extras.extra_journeys(tables["extras"], st.AS_OF, st.WHOLE_SPAN))

    got, wanted = map(built, reversed(stored))
    text = plan(got)
    assert rows_of(got) == rows_of(wanted) and wanted.count() > 0
    # the sums over days, and the final order, are all that moves
    assert "Exchange" not in text[text.index("SortMergeJoin") :]
    assert text.count("Exchange") == 2


def test_days_are_pruned_and_buckets_read(stored):
    text = plan(stored[1]["stop_events"].where(F.col("operating_day") == F.lit("2000-01-01").cast("date")))
    assert "PartitionFilters" in text and "operating_day" in text[text.index("PartitionFilters") :]


def test_in_step_with_the_deliveries(spark, rows, tmp_path):
    root = str(tmp_path)
    schema = "operating_day date, line_id string, journey_no string, idx int"

    def store(day, *numbers):
        made = rows("day string, line_id string, journey_no string, idx int", [("2024-01-05", "l", n, i) for n in numbers for i in (1, 2)])
        made = made.select(F.col("day").cast("date").alias("operating_day"), "line_id", "journey_no", "idx")
        assert made.schema.simpleString() == f"struct<{schema.replace(', ', ',').replace(' ', ':')}>"
        below = f"stop_events/version={deliveries.new_version()}/delivery_day={day}"
        day_files.write_version(day_files.align(made, day_files.struct("stop_events")), f"{root}/{below}", ("operating_day",))
        deliveries.publish(spark, root, [deliveries.Publication(day, {"stop_events": below})])

    read = lambda: sorted(r.journey_no for r in clustered.read_clustered(spark, root, "stop_events", 3).where("idx = 1").collect())
    store("2024-01-05", "1", "2", "")
    store("2024-01-06", "3")
    with pytest.raises(clustered.NotClustered):
        read()
    assert clustered.cluster_days(spark, root, "stop_events", 3) == ["2024-01-05", "2024-01-06"]
    assert read() == ["", "1", "2", "3"] and clustered.cluster_days(spark, root, "stop_events", 3) == []
    store("2024-01-05", "9")
    with pytest.raises(clustered.NotClustered):
        read()
    assert main(["cluster", "--target", root, "--buckets", "3"]) == {"stop_events": "2024-01-05"}
    assert main(["cluster", "--target", root, "--buckets", "3"]) == {"stop_events": "up to date"}
    assert read() == ["3", "9"]
    # a session that has never seen the tables declares them from the files
    for t in spark.catalog.listTables():
        if t.name.startswith("clustered_") and t.tableType == "EXTERNAL" and root in spark.sql(f"DESCRIBE EXTENDED {t.name}").where("col_name = 'Location'").first().data_type:
            spark.sql(f"DROP TABLE {t.name}")
    assert read() == ["3", "9"]
    deliveries.expire(spark, f"{root}/by_journey")
    assert read() == ["3", "9"]
    spark.conf.unset(clustered.CO_PARTITION)


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_stored_and_clustered_days_leave_no_shuffled_rows(spark, tmp_path):
    rows = day_files.align(st.delay_reports(spark, SF_DIR), day_files.struct("delay_reports"))
    rows = rows.withColumn("operating_day", F.trunc("operating_day", "year"))
    before = shuffled_bytes(spark)
    day_files.write_days(rows, str(tmp_path / "delay_reports"), "2001-07-30")
    clustered.cluster_days(spark, str(tmp_path), "delay_reports", BUCKETS)
    left = {name: n for name, n in shuffled_bytes(spark).items() if name not in before}
    assert sum(left.values()) < 20_000  # the lists of publications, sorted
