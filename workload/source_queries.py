"""Reads and writes: archive XML, day files, lists, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua import schemas
from punctua.operators import bundles, coverage, delays, segments
from punctua.plans.daily_ingest import delay_matrix, ingest_archive, read_rejected
from punctua.session import shared_folder
from punctua.sources import archive_xml, catalog, clustered, day_files, deliveries, master
from punctua.streaming import ingest
from workload import archive_text
from workload import standins as st
from workload.coverage_queries import every_bundle
from workload.join_queries import supplier_targets
from workload.registry import query

JOURNEY_ROWS = """
  SELECT operating_day::text AS operating_day, journey_no, destination, has_realtime, ever_reported,
    coalesce(operator, '') AS operator, line_id, line_id_short, line_short, reported_cancelled, journey_cancelled,
    ts_reported_cancelled, cancelled_any, device_id, client_id, rt_type, start_time,
    replace(start_station, ' ', ' & ') AS start_station, start_station_id, end_time, end_station, end_station_id
  FROM journeys"""


@query("S1 C2 C3 C4 C6 C7 T10", JOURNEY_ROWS)
def archive_journeys(spark, sf):
    folder = archive_text.archive_folder(spark, sf, "journeys")
    return archive_xml.journeys_from_archive(archive_xml.read_archive(spark, folder))


def by_month(spark, sf):
    """Journeys dated on the first of their month, as day tables hold many rows a day."""
    return st.journeys(spark, sf).withColumn("operating_day", F.trunc("operating_day", "month"))


def _land(spark, sf, rows, folder):
    """Archive files of journeys, none of them without an element."""
    archive_text.write_files(archive_text.journey_documents(spark, sf, archive_text.spread(rows)), folder)


@query("S18 S1 S12", JOURNEY_ROWS.replace("operating_day::text", "date_trunc('month', operating_day)::date::text"))
def streamed_archive_journeys(spark, sf):
    """Two deliveries by stream, the first delivered again with less, corrected by batch and served
    once more; extra journeys land beside it; a third delivery comes by batch alone."""
    landed, landing = shared_folder(spark, "landed"), shared_folder(spark, "landing")
    progress, served = shared_folder(spark, "progress"), shared_folder(spark, "served")
    rows = by_month(spark, sf)
    late = F.col("operating_day") >= F.lit("2000-01-01").cast("date")
    early = F.col("operating_day") < F.lit("1996-01-01").cast("date")

    def land(part, delivery):
        _land(spark, sf, part, f"{landed}/{delivery}")
        by_folder = r"/?([^/]+)/[^/]+$"
        ingest.land_new_files(spark, f"{landed}/*/", landing, progress, arrival_pattern=by_folder).awaitTermination()

    def by_batch(part, day):
        folder = shared_folder(spark, "batch")
        _land(spark, sf, part, folder)
        ingest_archive(spark, folder, served, day, ("journeys",))

    first = ~late & ~early
    land(rows.where(first), "2000-01-01-a")
    land(rows.where(late), "2000-01-02-a")
    land(rows.where(first & (F.col("line_short") != "1")), "2000-01-01-b")
    land(rows.where(late), "extra-2000-01-02")
    ingest.serve_deliveries(spark, landing, served, ("journeys",))
    by_batch(rows.where(first), "2000-01-01")
    by_batch(rows.where(early), "2000-01-03")
    ingest.serve_deliveries(spark, landing, served, ("journeys",))
    ingest.serve_deliveries(spark, landing, served, extra=True)
    return day_files.read_days(spark, "journeys", f"{served}/journeys")


@query("S18 S12", """
  SELECT * FROM (VALUES ('2000-01-01', 1::bigint, 'stream', 'journeys'), ('2000-01-02', 2, 'stream', 'journeys'),
    ('2000-01-01', 3, 'batch', 'journeys'), ('2000-01-02', 4, 'stream', 'extras')) AS t(delivery_day, number, source, "table"),
  LATERAL (SELECT count(*) AS total FROM journeys WHERE CASE number WHEN 1 THEN line_short <> '1' AND operating_day < DATE '2000-01-01'
    WHEN 3 THEN operating_day < DATE '2000-01-01' ELSE operating_day >= DATE '2000-01-01' END)""")
def served_arrivals(spark, sf):
    """The ledger: what was served, from where and with how many rows, in order; a second run serves nothing."""
    landed, landing = shared_folder(spark, "landed"), shared_folder(spark, "landing")
    progress, served = shared_folder(spark, "progress"), shared_folder(spark, "served")
    rows = by_month(spark, sf)
    late = F.col("operating_day") >= F.lit("2000-01-01").cast("date")
    for part, delivery in (
        (rows.where(~late & (F.col("line_short") != "1")), "2000-01-01"),
        (rows.where(late), "2000-01-02"), (rows.where(late), "2000-01-02-extra"),
    ):
        _land(spark, sf, part, f"{landed}/{delivery}")
    ingest.land_new_files(spark, landed, landing, progress).awaitTermination()
    ingest.serve_deliveries(spark, landing, served, ("journeys",))
    by_hand = shared_folder(spark, "batch")
    _land(spark, sf, rows.where(~late), by_hand)
    ingest_archive(spark, by_hand, served, "2000-01-01", ("journeys",))
    ingest.serve_deliveries(spark, landing, served, ("journeys",))
    ingest.serve_deliveries(spark, landing, served, extra=True)
    told = deliveries.ledger(spark, served).select("delivery_day", "number", "source", F.explode("rows").alias("table", "total"))
    return told.where(F.col("table").isin("journeys", "extras"))


@query("S5 U1 S12", """
  SELECT operating_day::text AS operating_day, journey_no, line_id, has_realtime AND operating_day < DATE '1999-10-01' AS has_realtime,
    CASE WHEN operating_day < DATE '1999-10-01' THEN '2000-01-01' ELSE '2000-01-02' END AS delivery_day
  FROM (SELECT * REPLACE (date_trunc('month', operating_day)::date AS operating_day) FROM journeys)""")
def newest_journeys(spark, sf):
    """Three months come in two deliveries: of each journey the newest delivery counts, once."""
    target, rows = shared_folder(spark, "deliveries"), by_month(spark, sf)
    turn, stray = F.lit("2000-01-01").cast("date"), F.lit("1999-10-01").cast("date")
    day_files.write_days(rows.where(F.col("operating_day") < turn), target, "2000-01-01")
    second = rows.where(F.col("operating_day") >= stray).withColumn("has_realtime", F.lit(False))
    day_files.write_days(second, target, "2000-01-02")
    newest = day_files.newest_rows(day_files.read_days(spark, "journeys", target, delivery_day=True))
    return newest.select("operating_day", "journey_no", "line_id", "has_realtime", "delivery_day")


@query("A12 S12 A5", """
  SELECT operating_day::text AS operating_day, tier, line_short, line_id_short, count(*) AS total,
    count(*) FILTER (ever_reported) AS total_rt,
    round(count(*) FILTER (ever_reported) / count(*) * 100) / 100 AS rate,
    (max(operating_day) FILTER (ever_reported))::text AS last_delivery
  FROM (SELECT * REPLACE (date_trunc('month', operating_day)::date AS operating_day) FROM known_journeys)
  GROUP BY operating_day, tier, line_short, line_id_short""")
def line_coverage_from_daily_counts(spark, sf):
    """Counts kept with each delivery, of which one is replaced, add up to those of all journeys."""
    target, rows = shared_folder(spark, "deliveries"), by_month(spark, sf)
    late = F.col("operating_day") >= F.lit("1998-01-01").cast("date")
    for part, delivery in ((rows.where(late), "2000-01-01"), (rows.where(late), "2000-01-02"), (rows.where(~late), "2000-01-01")):
        folder = shared_folder(spark, "batch")
        _land(spark, sf, part, folder)
        ingest_archive(spark, folder, target, delivery, ("journeys",))
    counts = day_files.read_days(spark, "journey_counts", f"{target}/journey_counts")
    # lines of the supplied tables carry the short id itself
    known = bundles.with_lines(counts, st.lines(spark, sf))
    return coverage.line_coverage_by_day(known, "1990-01-01", st.AS_OF, "ever_reported")


@query("S1 S12", """
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'does not parse' WHEN o_orderkey % 11 = 0 THEN 'no end tag'
    WHEN o_orderkey % 13 = 0 THEN 'no operating day' END AS reason, count(*) AS total FROM orders GROUP BY 1
  UNION ALL SELECT 'no element', count(*) FROM region""", prelude=False)
def archive_rejects(spark, sf):
    """Every start tag is accounted for: used, or set aside with a reason; blanks in an end tag and
    prefixes do no harm. Files without an element, one a region, are set aside as well; another
    table of the same day, delivered later, leaves all of this in place."""
    key, tag = F.col("o_orderkey"), archive_xml.ROW_TAG
    day = F.when(key % 13 == 0, "soon").otherwise("2024-01-10T00:00:00+01:00")
    number = F.concat(F.lit("<journeyID>"), key.cast("string"), F.lit("</journeyID>"))
    inner = F.concat(
        F.lit("<journey><operatingDay>"), day, F.lit("</operatingDay>"), number,
        F.when(key % 7 == 0, "</journey_>").otherwise("</journey>"),
    )
    end = F.when((key % 11 == 0) & (key % 7 != 0), "").when(key % 2 == 0, f"</{tag} >").otherwise(f"</{tag}>")
    landed, target = shared_folder(spark, "landed"), shared_folder(spark, "deliveries")
    plain = F.concat(F.lit(f"<{tag}>"), inner, end)
    prefixed = F.regexp_replace(F.regexp_replace(plain, "</", "</x:"), "<(?!/)", "<x:")
    whole = (key % 17 == 0) & (key % 7 != 0) & (key % 11 != 0)
    orders = archive_text.spread(st.table(spark, sf, "orders").select("o_orderkey"))
    archive_text.write_files(orders.select(F.when(whole, prefixed).otherwise(plain)), landed)
    other = st.table(spark, sf, "region").select(F.col("r_regionkey").alias("part"), F.lit("<other/>").alias("text"))
    other.write.partitionBy("part").text(f"{landed}-other")
    files = [landed, f"{landed}-other/*"]
    paths = ingest_archive(spark, files, target, "2024-01-10", ("journeys",), allow_rejected=True)
    extras = shared_folder(spark, "landed")
    _land(spark, sf, by_month(spark, sf), extras)
    ingest_archive(spark, extras, target, "2024-01-10", ("extras",))
    used = day_files.read_days(spark, "journeys", paths["journeys"])
    aside = read_rejected(spark, target)
    both = used.select(F.lit(None).cast("string").alias("reason")).unionByName(aside.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("total"))


@query("S12 S5", """
  SELECT operating_day::text AS operating_day, journey_no, line_id, has_realtime AND operating_day < DATE '2000-01-01' AS has_realtime
  FROM (SELECT * REPLACE (date_trunc('month', operating_day)::date AS operating_day) FROM journeys)
  WHERE operating_day < DATE '2000-01-01'
  UNION ALL
  SELECT operating_day::text, journey_no, line_id, false
  FROM (SELECT * REPLACE (date_trunc('month', operating_day)::date AS operating_day) FROM journeys)
  WHERE operating_day >= DATE '1999-10-01'""")
def redelivered_days(spark, sf):
    """The second delivery carries stray rows of the first one's days, and comes twice: nothing is lost or doubled."""
    target, rows = shared_folder(spark, "deliveries"), by_month(spark, sf)
    turn, stray = F.lit("2000-01-01").cast("date"), F.lit("1999-10-01").cast("date")
    day_files.write_days(rows.where(F.col("operating_day") < turn), target, "2000-01-01")
    second = rows.where(F.col("operating_day") >= stray).withColumn("has_realtime", F.lit(False))
    day_files.write_days(rows, target, "2000-01-02")
    day_files.write_days(second, target, "2000-01-02")
    stored = day_files.read_days(spark, "journeys", target)
    return stored.select("operating_day", "journey_no", "line_id", "has_realtime")


@query("S2 C1 C5 C9 C12", """
  SELECT operating_day::text AS operating_day, operator, device_id, line_short, line_id,
    line_id_short || ':1' AS line_id_short, journey_no, idx, has_rt,
    strftime(sched_dep, '%Y-%m-%d %H:%M:%S') AS sched_dep, strftime(sched_arr, '%Y-%m-%d %H:%M:%S') AS sched_arr,
    dep_delay, arr_delay, station_no, station_name, lat, lon, cancelled, additional, ts_reported_cancelled, reported_cancelled
  FROM (SELECT * REPLACE ('de:NET:' || split_part(line_id, ':', 3) AS line_id_short) FROM stop_reports)
  UNION ALL
  SELECT operating_day::text, operator, device_id, line_short, line_id, line_id_short || ':1', journey_no, idx + 100, has_rt,
    NULL, NULL, NULL, NULL, station_no || '9', '-', lat, lon, false, false, ts_reported_cancelled, reported_cancelled
  FROM stop_reports""".replace("line_id_short || ':1'", "line_id_short"))
def archive_stop_events(spark, sf):
    archive = archive_xml.read_archive(spark, archive_text.archive_folder(spark, sf, "stops"), "stop_events")
    return archive_xml.stop_events_from_archive(archive)


REPORT_ROWS = """
  , told AS (
    SELECT *, strftime(sched_dep, '%Y%m%d%H%M%S') AS planned,
      strftime(timezone('Europe/Berlin', timezone('UTC', operating_day::timestamp + to_days(idx) + interval '5 hours 30 minutes')),
        '%Y-%m-%d %H:%M:%S') AS reported_at
    FROM stop_reports WHERE NOT additional),
  reported AS (
    SELECT operating_day::text AS operating_day, operator, line_short, line_id, journey_no, planned AS sched_dep,
      station_no::int AS station_no, arr_delay AS delay_arrival, dep_delay AS delay_departure, cancelled AS stop_cancelled, reported_at
    FROM told
    UNION ALL
    SELECT operating_day::text, operator, line_short, line_id, journey_no, planned, station_no::int, arr_delay, NULL, false, reported_at
    FROM told)
"""


@query("S3 C8 C10 P18 T17", REPORT_ROWS + "SELECT * FROM reported")
def archive_delay_reports(spark, sf):
    archive = archive_xml.read_archive(spark, archive_text.archive_folder(spark, sf, "stops"), "delay_reports")
    return archive_xml.delay_reports_from_archive(archive)


@query("S4 A15", """
  SELECT DISTINCT station_no, lat, lon, station_name FROM stop_reports
  UNION SELECT station_no || '9', lat, lon, NULL FROM stop_reports""")
def archive_stations(spark, sf):
    archive = archive_xml.read_archive(spark, archive_text.archive_folder(spark, sf, "stops"), "stations")
    return archive_xml.stations_from_archive(archive)


OLD_ROWS = """
  SELECT operating_day::text AS operating_day, journey_no, destination, has_realtime, ever_reported, operator,
    line_id, line_id_padded AS line_id_short, line_short, reported_cancelled, {cancelled} AS journey_cancelled,
    ts_reported_cancelled, cancelled_any, device_id, client_id, rt_type, start_time, start_station, start_station_id,
    end_time, end_station, {last} AS end_station_id
  FROM (SELECT *, 'de:NET:' || split_part(line_id, ':', 3) AS line_id_padded FROM journeys) WHERE {where}"""


_OLD_FILES: dict[tuple[str, str], list[str]] = {}


def old_day_files(spark, sf):
    """Folders of recent and of older day files, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _OLD_FILES and all(deliveries.exists(spark, f) for f in _OLD_FILES[key]):
        return _OLD_FILES[key]
    rows = st.journeys(spark, sf)
    boundary = F.lit("1998-01-01").cast("date")
    recent, older = shared_folder(spark, "day-files"), shared_folder(spark, "old-day-files")
    rows.where(F.col("operating_day") < boundary).drop("line_id_short").write.parquet(recent)
    new_to_old = {new: old for old, new in schemas.OLD_NAMES["journeys"].items()}
    (
        rows.where(F.col("operating_day") >= boundary)
        .withColumn("operating_day", F.date_format("operating_day", "yyyy-MM-dd"))
        .withColumn("journey_cancelled", F.when(F.col("journey_cancelled"), "True").otherwise(""))
        .drop("end_station_id", "line_id_short")
        .withColumnsRenamed(new_to_old)
        .write.parquet(older)
    )
    _OLD_FILES[key] = [recent, older]
    return _OLD_FILES[key]


@query("S5 U1 C9 T6 T7 T18", OLD_ROWS.format(cancelled="journey_cancelled", last="end_station_id", where="operating_day < DATE '1998-01-01'")
       + " UNION ALL " + OLD_ROWS.format(cancelled="CASE WHEN journey_cancelled THEN true END", last="NULL", where="operating_day >= DATE '1998-01-01'"))
def day_files_of_two_generations(spark, sf):
    """Files with declared types, and older ones with old names, text days and a column less; stored once as days."""
    return day_files.migrate_day_files(spark, "journeys", old_day_files(spark, sf), shared_folder(spark, "days"))


@query("S5", """
  SELECT rows_per_file > 0 AS filled, sum(rows_per_file)::bigint AS total FROM (SELECT count(*) AS rows_per_file FROM journeys) GROUP BY 1""")
def day_files_with_names(spark, sf):
    folder = shared_folder(spark, "day-files")
    st.journeys(spark, sf).write.parquet(folder)
    rows = day_files.read_day_files(spark, "journeys", [folder], source_file=True)
    per_file = rows.groupBy(day_files.SOURCE_FILE).agg(F.count("*").alias("n"))
    return per_file.groupBy((F.col("n") > 0).alias("filled")).agg(F.sum("n").alias("total"))


@query("S12 S5", """
  SELECT date_trunc('month', operating_day)::date::text AS operating_day, journey_no, line_id,
    has_realtime AND operating_day < DATE '2000-01-01' AS has_realtime
  FROM journeys""")
def rewritten_days(spark, sf):
    """Stores two deliveries, then the second one again with changed rows."""
    target = shared_folder(spark, "days")
    rows = by_month(spark, sf)
    later = F.col("operating_day") >= F.lit("2000-01-01").cast("date")
    day_files.write_days(rows.where(~later), target, "2000-01-01")
    day_files.write_days(rows.where(later), target, "2000-01-02")
    day_files.write_days(rows.where(later).withColumn("has_realtime", F.lit(False)), target, "2000-01-02")
    return day_files.read_days(spark, "journeys", target).select(
        "operating_day", "journey_no", "line_id", "has_realtime"
    )


@query("S9 P7", "SELECT operating_day::text AS operating_day, journey_no, line_id, idx, station_no FROM stop_reports WHERE operating_day = DATE '2000-01-10'")
def scan_of_one_day(spark, sf):
    catalog.register(spark, stop_reports=st.stop_reports(spark, sf))
    day = catalog.scan_day(spark, "stop_reports", "2000-01-10")
    return day.select("operating_day", "journey_no", "line_id", "idx", "station_no")


@query("S10", "SELECT line_short, client_id, count(*) AS total FROM journeys GROUP BY ALL")
def scan_by_name(spark, sf):
    catalog.register(spark, journeys=st.journeys(spark, sf))
    return catalog.scan(spark, "journeys").groupBy("line_short", "client_id").agg(F.count("*").alias("total"))


@query("S7 S13 J3", """
  SELECT line, bundle, tier, line_id_short, count(*) AS total FROM known_journeys JOIN (SELECT line, line_id_short FROM lines) USING (line_id_short) GROUP BY ALL""")
def lines_from_csv_cache(spark, sf):
    path = shared_folder(spark, "lines-csv")
    master.write_lines_csv(st.lines(spark, sf), path)
    lines = master.read_lines_csv(spark, path)
    counts = st.journeys(spark, sf).groupBy("line_id_short").agg(F.count("*").alias("total"))
    return lines.join(counts, "line_id_short").select("line", "bundle", "tier", "line_id_short", "total")


@query("S8", """
  SELECT 'buendel_sued_' || s_suppkey AS slug, 'https://example.org/p/' || (s_suppkey % 7) AS project_url,
    (s_suppkey + 1000)::int AS folder_id FROM supplier""", prelude=False)
def publication_targets_csv(spark, sf):
    path = shared_folder(spark, "targets-csv")
    quoted = supplier_targets(spark, sf).write.option("sep", ";").option("quote", "'")
    quoted.option("quoteAll", "true").option("header", "true").csv(path)
    return master.read_publication_targets(spark, path)


@query("S14", """
  SELECT operating_day::text AS operating_day, journey_no, bundle, tier, has_realtime FROM known_journeys""")
def materialised_result(spark, sf):
    rows = every_bundle(spark, sf).select("operating_day", "journey_no", "bundle", "tier", "has_realtime")
    return catalog.materialise(rows, shared_folder(spark, "result"))


@query("S3 S4 J5 P18 C10", REPORT_ROWS + """
  , listed AS (
    SELECT DISTINCT station_no, lat, lon, station_name FROM stop_reports
    UNION SELECT station_no || '9', lat, lon, NULL FROM stop_reports)
  SELECT r.*, l.station_name FROM reported r LEFT JOIN listed l ON r.station_no::text = l.station_no""")
def delay_matrix_from_archive(spark, sf):
    folder = archive_text.archive_folder(spark, sf, "stops")
    stations = archive_xml.stations_from_archive(archive_xml.read_archive(spark, folder, "stations"))
    stored = catalog.materialise(stations, shared_folder(spark, "stations"))
    return delay_matrix(archive_xml.read_archive(spark, folder, "delay_reports"), stations=stored)


def _clustered(spark, root, name, rows):
    """A table of two deliveries, clustered by journey; a journey's rows come with different ones."""
    dated = day_files.align(rows.withColumn("operating_day", F.trunc("operating_day", "quarter")), schemas.struct(name))
    both = F.array(F.lit("2001-07-30"), F.lit("2001-07-31"))
    dated = dated.withColumn(deliveries.DELIVERY, F.get(both, F.pmod(F.xxhash64(*dated.columns), F.lit(2)).cast("int")))
    version = f"{name}/{deliveries.VERSION}={deliveries.new_version()}"
    # in one pass; rows of a journey, side by side, take less room here and on their way to the buckets
    order = clustered.ORDER.get(name, ("line_id", "journey_no"))
    day_files.write_version(dated, f"{root}/{version}", (deliveries.DELIVERY, "operating_day"), order)
    stored = [n for n in deliveries.names(spark, f"{root}/{version}") if n.startswith(f"{deliveries.DELIVERY}=")]
    lines = [deliveries.Publication(n.partition("=")[2], {name: f"{version}/{n}"}) for n in stored]
    deliveries.publish(spark, root, lines)
    clustered.cluster_days(spark, root, name, 8)
    return clustered.read_clustered(spark, root, name, 8)


def _dated(rows):
    """Journeys numbered by their day, as the tables below are dated by quarter."""
    number = F.concat("journey_no", F.lit("-"), F.col("operating_day").cast("string"))
    return rows.withColumn("journey_no", number)


@query("W1 J9 S12", """
  SELECT date_trunc('quarter', operating_day)::date::text AS operating_day, line_id,
    journey_no || '-' || operating_day AS journey_no, idx, station_no,
    lead(idx) OVER w AS idx_next, lead(station_no) OVER w AS station_no_next
  FROM stop_events WINDOW w AS (PARTITION BY operating_day, line_id, journey_no ORDER BY idx) QUALIFY idx_next IS NOT NULL""")
def next_stops_of_clustered_days(spark, sf):
    stops = _clustered(spark, shared_folder(spark, "clustered"), "stop_events", _dated(st.stop_events(spark, sf)))
    linked = segments.next_stops(stops, ("idx", "station_no"))
    return linked.select("operating_day", "line_id", "journey_no", "idx", "station_no", "idx_next", "station_no_next")


@query("J4 S12", """
  SELECT date_trunc('quarter', m.operating_day)::date::text AS operating_day, m.line_short, m.line_id,
    m.journey_no || '-' || m.operating_day AS journey_no, v.idx, m.station_name,
    m.sched_dep, m.delay_arrival, m.delay_departure, m.reported_at, v.arr_delay, v.dep_delay
  FROM delay_reports m LEFT JOIN stop_events v
    ON m.operating_day = v.operating_day AND m.line_short = v.line_short
    AND m.journey_no = v.journey_no AND m.station_name = v.station_name
  WHERE stop_cancelled = false""")
def reports_with_clustered_stops(spark, sf):
    root = shared_folder(spark, "clustered")
    reports = _clustered(spark, root, "delay_reports", _dated(st.delay_reports(spark, sf)))
    return delays.reports_with_stops(reports, _clustered(spark, root, "stop_events", _dated(st.stop_events(spark, sf))))
