"""Stop events, delay reports and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions import geo
from punctua.operators import delays, segments, stations
from workload import standins as st
from workload.coverage_queries import AS_OF
from workload.registry import query


@query("A11 P5 P12 O1", """
  SELECT line_id, journey_no, min(operating_day)::text AS first_day, max(operating_day)::text AS last_day, count(*) AS days
  FROM (
    SELECT operating_day, line_id, journey_no, avg(dep_delay) AS mean
    FROM stop_events WHERE dep_delay IS NOT NULL AND has_rt = true GROUP BY ALL)
  WHERE mean = 0 AND line_id LIKE 'de:NET:%' AND operating_day > DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01'
  GROUP BY ALL HAVING count(*) > 3""")
def flat_zero_journeys(spark, sf):
    return delays.flat_zero_journeys(st.stop_events(spark, sf), AS_OF, st.WHOLE_SPAN, "de:NET:%")


@query("A11", """
  SELECT line_id, journey_no, min(operating_day)::text AS first_day, max(operating_day)::text AS last_day, count(*) AS days
  FROM (
    SELECT operating_day, line_id, journey_no, max(abs(dep_delay)) AS most
    FROM stop_events WHERE dep_delay IS NOT NULL AND has_rt = true GROUP BY ALL)
  WHERE most = 0 GROUP BY ALL HAVING count(*) > 3""")
def only_zero_journeys(spark, sf):
    return delays.flat_zero_journeys(st.stop_events(spark, sf), AS_OF, st.WHOLE_SPAN, strict_zero=True)


@query("P5", """
  SELECT operating_day::text AS operating_day, line_id, journey_no, idx, dep_delay
  FROM stop_events WHERE dep_delay IS NOT NULL AND has_rt = true""")
def stops_with_realtime(spark, sf):
    kept = st.stop_events(spark, sf).where(F.col("dep_delay").isNotNull() & F.col("has_rt"))
    return kept.select("operating_day", "line_id", "journey_no", "idx", "dep_delay")


@query("J4 P19 O1", """
  SELECT m.operating_day::text AS operating_day, m.line_short, m.line_id, m.journey_no, v.idx, m.station_name,
    m.sched_dep, m.delay_arrival, m.delay_departure, m.reported_at, v.arr_delay, v.dep_delay
  FROM delay_reports m LEFT JOIN stop_events v
    ON m.operating_day = v.operating_day AND m.line_short = v.line_short
    AND m.journey_no = v.journey_no AND m.station_name = v.station_name
  WHERE stop_cancelled = false""")
def reports_with_stops(spark, sf):
    return delays.reports_with_stops(st.delay_reports(spark, sf), st.stop_events(spark, sf))


@query("J5 P18", """
  SELECT r.operating_day::text AS operating_day, r.operator, r.line_short, r.line_id, r.journey_no, r.sched_dep, r.station_no,
    r.delay_arrival, r.delay_departure, r.stop_cancelled, r.reported_at, s.station_name
  FROM delay_reports r LEFT JOIN stations s ON r.station_no::text = s.station_no
  WHERE r.sched_dep <> ''""")
def reports_with_station_names(spark, sf):
    return delays.reports_with_station_names(st.delay_reports(spark, sf), st.stations(spark, sf))


@query("P18", "SELECT operating_day::text AS operating_day, journey_no, station_no, sched_dep, reported_at FROM delay_reports WHERE NOT (sched_dep = '')")
def reports_with_departure(spark, sf):
    kept = st.delay_reports(spark, sf).where(F.col("sched_dep") != "")
    return kept.select("operating_day", "journey_no", "station_no", "sched_dep", "reported_at")


@query("P19", "SELECT line_short, count(*) AS total FROM delay_reports WHERE stop_cancelled = false GROUP BY ALL")
def reports_not_cancelled(spark, sf):
    kept = st.delay_reports(spark, sf).where(~F.col("stop_cancelled"))
    return kept.groupBy("line_short").agg(F.count("*").alias("total"))


PLAUSIBLE = """
  , plausible AS (
    SELECT * FROM stop_events WHERE dep_delay IS NOT NULL AND dep_delay < 30
      AND operating_day >= DATE '1995-01-01' AND operating_day <= DATE '2001-12-31')
"""


def _plausible(spark, sf):
    return delays.plausible_delays(st.stop_events(spark, sf), "1995-01-01", "2001-12-31")


@query("P16 P9 O2", PLAUSIBLE + "SELECT operating_day::text AS operating_day, journey_no, idx, station_name, dep_delay FROM plausible")
def plausible_delays(spark, sf):
    columns = ("operating_day", "journey_no", "idx", "station_name", "dep_delay")
    return _plausible(spark, sf).select(*columns)


@query("A20 C14", PLAUSIBLE + """
  , named AS (
    SELECT line_short, journey_no, idx, arg_min(station_name, (operating_day, station_name)) AS station_name
    FROM plausible GROUP BY ALL)
  SELECT line_short, journey_no, idx, station_name,
    lpad(idx::text, greatest(2, length(idx::text))::int, '0') || ' ' || left(CASE
      WHEN contains(station_name, ' ') THEN substr(station_name, strpos(station_name, ' ') + 1) ELSE station_name END, 8) AS label
  FROM named""")
def stop_labels_first(spark, sf):
    return delays.stop_labels(_plausible(spark, sf))


@query("A20", PLAUSIBLE + """
  , named AS (
    SELECT line_short, journey_no, idx, arg_max(station_name, (operating_day, station_name)) AS station_name
    FROM plausible GROUP BY ALL)
  SELECT line_short, journey_no, idx, station_name,
    lpad(idx::text, greatest(2, length(idx::text))::int, '0') || ' ' || left(CASE
      WHEN contains(station_name, ' ') THEN substr(station_name, strpos(station_name, ' ') + 1) ELSE station_name END, 8) AS label
  FROM named""")
def stop_labels_last(spark, sf):
    return delays.stop_labels(_plausible(spark, sf), "last")


@query("A21", PLAUSIBLE + """
  SELECT line_short, journey_no, count(DISTINCT operating_day) AS days,
    min(operating_day)::text AS first_day, max(operating_day)::text AS last_day FROM plausible GROUP BY ALL""")
def journey_days(spark, sf):
    return delays.journey_days(_plausible(spark, sf))


BOX = """
  , box AS (
    SELECT line_short, journey_no, idx, count(*) AS n, quantile_cont(dep_delay, 0.25) AS q1,
      quantile_cont(dep_delay, 0.5) AS median, quantile_cont(dep_delay, 0.75) AS q3
    FROM chosen WHERE dep_delay IS NOT NULL GROUP BY ALL),
  fenced AS (
    SELECT c.*, b.n, b.q1, b.median, b.q3,
      dep_delay BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM chosen c JOIN box b USING (line_short, journey_no, idx) WHERE dep_delay IS NOT NULL)
"""
BOX_ROWS = """
  SELECT line_short, journey_no, idx, n, q1, median, q3,
    least(min(dep_delay) FILTER (inside), q1) AS whisker_low, greatest(max(dep_delay) FILTER (inside), q3) AS whisker_high,
    count(*) FILTER (NOT inside) AS outliers
  FROM fenced GROUP BY line_short, journey_no, idx, n, q1, median, q3"""


@query("A22 P16", PLAUSIBLE + ", chosen AS (SELECT * FROM plausible)" + BOX + BOX_ROWS)
def boxplot_per_stop(spark, sf):
    return delays.boxplot(_plausible(spark, sf))


@query("A22", ", chosen AS (SELECT * FROM stop_events)" + BOX + BOX_ROWS)
def boxplot_without_cut(spark, sf):
    return delays.boxplot(st.stop_events(spark, sf))


@query("A22", ", chosen AS (SELECT * FROM stop_events)" + BOX + """
  SELECT line_short, journey_no, idx, dep_delay, count(*) AS n FROM fenced WHERE NOT inside GROUP BY ALL""")
def boxplot_outliers(spark, sf):
    return delays.boxplot_outliers(st.stop_events(spark, sf))


PRICES = """
  WITH chosen AS (SELECT l_returnflag, l_linestatus, l_extendedprice::double AS price FROM lineitem),
  box AS (
    SELECT l_returnflag, l_linestatus, count(*) AS n, quantile_cont(price, 0.25) AS q1,
      quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
    FROM chosen WHERE price IS NOT NULL GROUP BY ALL),
  fenced AS (
    SELECT c.*, n, q1, median, q3, price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM chosen c JOIN box USING (l_returnflag, l_linestatus) WHERE price IS NOT NULL)
"""


@query("A22", PRICES + """
  SELECT l_returnflag, l_linestatus, n, q1, median, q3, least(min(price) FILTER (inside), q1) AS whisker_low,
    greatest(max(price) FILTER (inside), q3) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
  FROM fenced GROUP BY l_returnflag, l_linestatus, n, q1, median, q3""", prelude=False)
def boxplot_of_continuous(spark, sf):
    """Few groups, each with a large part of all rows, of values that seldom repeat."""
    rows = st.table(spark, sf, "lineitem")
    return delays.boxplot(rows, ("l_returnflag", "l_linestatus"), "l_extendedprice", continuous=True)


NEXT = """
  , linked AS (
    SELECT *, lead(idx) OVER w AS idx_next, lead(station_no) OVER w AS station_no_next,
      lead(sched_arr) OVER w AS sched_arr_next, lead(arr_delay) OVER w AS arr_delay_next,
      lead(lat) OVER w AS lat_next, lead(lon) OVER w AS lon_next
    FROM stop_events WINDOW w AS (PARTITION BY operating_day, line_id, journey_no ORDER BY idx)
    QUALIFY idx_next IS NOT NULL)
"""


@query("W1 J9 T16", NEXT + """
  SELECT operating_day::text AS operating_day, line_id, journey_no, idx, station_no, idx_next, station_no_next,
    strftime(sched_dep, '%Y-%m-%d %H:%M:%S') AS sched_dep, strftime(sched_arr_next, '%Y-%m-%d %H:%M:%S') AS sched_arr_next
  FROM linked""")
def next_stops(spark, sf):
    linked = segments.next_stops(st.stop_events(spark, sf), ("idx", "station_no", "sched_arr"))
    return linked.select(
        "operating_day", "line_id", "journey_no", "idx", "station_no", "idx_next",
        "station_no_next", "sched_dep", "sched_arr_next",
    )


UNNUMBERED = "CASE WHEN journey_no LIKE '%7' THEN '' WHEN journey_no LIKE '%8' THEN NULL ELSE journey_no END"


def _some_unnumbered(spark, sf):
    """Stop events of which some journeys carry no number, as '' or NULL."""
    number = F.col("journey_no")
    number = F.when(number.endswith("7"), "").when(number.endswith("8"), None).otherwise(number)
    return st.stop_events(spark, sf).withColumn("journey_no", number)


@query("W1 J9", f"""
  , partly AS (SELECT * REPLACE ({UNNUMBERED} AS journey_no) FROM stop_events)
  SELECT operating_day::text AS operating_day, line_id, journey_no, idx, station_no,
    lead(idx) OVER w AS idx_next, lead(station_no) OVER w AS station_no_next
  FROM partly WHERE journey_no <> ''
  WINDOW w AS (PARTITION BY operating_day, line_id, journey_no ORDER BY idx) QUALIFY idx_next IS NOT NULL""")
def next_stops_of_numbered(spark, sf):
    linked = segments.next_stops(_some_unnumbered(spark, sf), ("idx", "station_no"))
    return linked.select("operating_day", "line_id", "journey_no", "idx", "station_no", "idx_next", "station_no_next")


@query("J9", """
  SELECT operating_day::text AS operating_day, line_id, journey_no, idx, count(*) AS rows
  FROM stop_reports GROUP BY ALL HAVING count(*) > 1""")
def repeated_stops(spark, sf):
    return segments.repeated_stops(st.stop_reports(spark, sf))


@query("J4", f"""
  , partly AS (SELECT * REPLACE ({UNNUMBERED} AS journey_no) FROM stop_events),
  some_reports AS (SELECT * REPLACE ({UNNUMBERED} AS journey_no) FROM delay_reports)
  SELECT m.operating_day::text AS operating_day, m.line_short, m.line_id, m.journey_no, v.idx, m.station_name,
    m.sched_dep, m.delay_arrival, m.delay_departure, m.reported_at, v.arr_delay, v.dep_delay
  FROM some_reports m LEFT JOIN partly v
    ON m.operating_day = v.operating_day AND m.line_short = v.line_short AND m.journey_no <> ''
    AND m.journey_no = v.journey_no AND m.station_name = v.station_name
  WHERE stop_cancelled = false""")
def unnumbered_reports_with_stops(spark, sf):
    number = F.col("journey_no")
    number = F.when(number.endswith("7"), "").when(number.endswith("8"), None).otherwise(number)
    reports = st.delay_reports(spark, sf).withColumn("journey_no", number)
    return delays.reports_with_stops(reports, _some_unnumbered(spark, sf))


@query("J5", """
  , texts AS (SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN '00' || l_suppkey ELSE l_suppkey::text END AS station_no)
    FROM (SELECT operating_day, journey_no, station_no, sched_dep, reported_at, station_no AS l_suppkey FROM delay_reports)),
  places AS (SELECT station_no, station_name FROM stations
    UNION ALL SELECT '00' || station_no, 'Padded ' || station_no FROM stations WHERE station_no::int % 6 = 0)
  SELECT r.operating_day::text AS operating_day, r.journey_no, r.sched_dep, r.reported_at, r.station_no::int AS station_no, s.station_name
  FROM texts r LEFT JOIN places s USING (station_no) WHERE r.sched_dep <> ''""")
def padded_station_numbers(spark, sf):
    """ "0012" and "12" are two stations."""
    number, places = F.col("station_no").cast("string"), st.stations(spark, sf)
    padded = places.where(F.col("station_no").cast("int") % 6 == 0).select(
        F.concat(F.lit("00"), "station_no").alias("station_no"),
        F.concat(F.lit("Padded "), "station_no").alias("station_name"),
    )
    reports = st.delay_reports(spark, sf).select(
        "operating_day", "journey_no", "sched_dep", "reported_at",
        F.when(F.col("station_no") % 3 == 0, F.concat(F.lit("00"), number)).otherwise(number).alias("station_no"),
    )
    both = places.select("station_no", "station_name").unionByName(padded)
    return delays.reports_with_station_names(reports, both)


# Stations of the line items: every third one is renamed with each year, on its first day.
RENAMED = """
  , calls AS (
    SELECT operating_day, station_no, CASE WHEN station_no::int % 3 = 0
      THEN 'Halt ' || station_no || ' of ' || year(operating_day) ELSE station_name END AS station_name
    FROM stop_reports),
  daily AS (
    SELECT station_no, operating_day, station_name FROM calls GROUP BY station_no, operating_day, station_name
    QUALIFY row_number() OVER (PARTITION BY station_no, operating_day ORDER BY count(*) DESC, station_name) = 1),
  changes AS (
    SELECT *, row_number() OVER w = 1 AS first_of_all, lag(station_name) OVER w AS earlier
    FROM daily WINDOW w AS (PARTITION BY station_no ORDER BY operating_day)),
  intervals AS (
    SELECT station_no, station_name, CASE WHEN NOT first_of_all THEN operating_day END AS valid_from,
      lead(operating_day) OVER (PARTITION BY station_no ORDER BY operating_day) - 1 AS valid_until
    FROM changes WHERE first_of_all OR earlier <> station_name)
"""


def _intervals(spark, sf):
    year, number = F.year("operating_day").cast("string"), F.col("station_no")
    renamed = F.when(number.cast("int") % 3 == 0, F.concat(F.lit("Halt "), number, F.lit(" of "), year))
    calls = st.stop_reports(spark, sf).withColumn("station_name", renamed.otherwise(F.col("station_name")))
    return stations.station_intervals(calls, ("station_name",))


@query("S4 J5", RENAMED + """
  SELECT station_no, station_name, valid_from::text AS valid_from, valid_until::text AS valid_until FROM intervals""")
def station_name_intervals(spark, sf):
    return _intervals(spark, sf)


@query("J5 S4", RENAMED + """
  SELECT r.operating_day::text AS operating_day, r.line_id, r.journey_no, r.station_no, r.sched_dep, r.reported_at, i.station_name
  FROM delay_reports r LEFT JOIN intervals i ON r.station_no::text = i.station_no
    AND r.operating_day >= coalesce(i.valid_from, DATE '0001-01-01') AND r.operating_day <= coalesce(i.valid_until, DATE '9999-12-31')
  WHERE r.sched_dep <> ''""")
def reports_with_names_of_day(spark, sf):
    named = stations.reports_with_names_of_day(st.delay_reports(spark, sf), _intervals(spark, sf))
    return named.select("operating_day", "line_id", "journey_no", "station_no", "sched_dep", "reported_at", "station_name")


def _metres(lat: str, lon: str, suffix: str) -> str:
    """The projection as SQL, one subquery level per step."""
    k = geo.KRUEGER
    e, n = f"eta{suffix}", f"xi{suffix}"
    east = f"{e}" + "".join(f" + {k[j]!r} * cos({2 * j + 2} * {n}) * sinh({2 * j + 2} * {e})" for j in range(4))
    north = f"{n}" + "".join(f" + {k[j]!r} * sin({2 * j + 2} * {n}) * cosh({2 * j + 2} * {e})" for j in range(4))
    size = geo.SCALE * geo.RECTIFYING_RADIUS
    return f"{size!r}::double * ({east}) AS east{suffix}, {size!r}::double * ({north}) AS north{suffix}"


def _sphere(lat: str, lon: str, suffix: str) -> str:
    t = f"sinh(atanh(sin(radians({lat}))) - {geo._E!r} * atanh({geo._E!r} * sin(radians({lat}))))"
    away = f"radians({lon} - 9.0)"
    return (
        f"atan2({t}, cos({away})) AS xi{suffix}, "
        f"asinh(sin({away}) / sqrt({t} * {t} + cos({away}) * cos({away}))) AS eta{suffix}"
    )


SEGMENTS = NEXT + f"""
  , sphere AS (SELECT *, {_sphere("lat", "lon", "")}, {_sphere("lat_next", "lon_next", "_next")} FROM linked),
  projected AS (SELECT *, {_metres("lat", "lon", "")}, {_metres("lat_next", "lon_next", "_next")} FROM sphere),
  lengths AS (
    SELECT *, trunc(sqrt((east_next - east) * (east_next - east) + (north_next - north) * (north_next - north)))::int AS metres,
      (((date_diff('second', sched_dep, sched_arr_next) % 86400) + 86400) % 86400)::int AS seconds
    FROM projected)
"""


@query("W2 C16 C17 C18 C19", SEGMENTS + """
  SELECT operating_day::text AS operating_day, line_id, journey_no, idx, idx_next, metres, seconds,
    CASE WHEN seconds = 0 AND metres > 1000 THEN 999.0::double WHEN seconds = 0 THEN 1.0::double
      ELSE metres / seconds * 3.6::double END AS km_h,
    arr_delay_next - arr_delay AS delay_change
  FROM lengths""")
def segment_metrics(spark, sf):
    return segments.segments(st.stop_events(spark, sf)).select(
        "operating_day", "line_id", "journey_no", "idx", "idx_next", "metres", "seconds", "km_h", "delay_change"
    )


@query("C23", SEGMENTS + """
  SELECT line_id, journey_no, CASE WHEN count(*) FILTER (seconds = 0) = 0 THEN 1 ELSE count(*) FILTER (seconds = 0) END AS no_time
  FROM lengths GROUP BY line_id, journey_no""")
def one_if_zero(spark, sf):
    from punctua.functions.numbers import one_if_zero as guard

    counted = segments.segments(st.stop_events(spark, sf)).groupBy("line_id", "journey_no")
    return counted.agg(guard(F.count_if(F.col("seconds") == 0)).cast("bigint").alias("no_time"))


@query("C11 O2", """
  SELECT hour(sched_dep)::int AS hour, operating_day::text AS day, count(*) AS total FROM stop_events GROUP BY ALL""")
def departures_by_hour(spark, sf):
    from punctua.functions.days import day_text

    return (
        st.stop_events(spark, sf)
        .groupBy(F.hour("sched_dep").alias("hour"), day_text(F.col("operating_day")).alias("day"))
        .agg(F.count("*").alias("total"))
    )
