"""Joins to lines, bundles, extras and publication targets; the bundle reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.operators import bundles, extras, listing
from punctua.plans.bundle_report import bundle_sheet
from punctua.sources import master
from workload import standins as st
from workload.coverage_queries import AS_OF, INCIDENTS, QUOTED_RECENT, RATE, SPAN, every_bundle
from workload.registry import query

VIEW = """operating_day::text AS operating_day, tier, operator, journey_no, start_station, end_station,
    line_short, line_id_short, has_realtime, journey_cancelled, reported_cancelled, ts_reported_cancelled, ever_reported"""
STOP_VIEW = """operating_day::text AS operating_day, tier, journey_no, idx, station_no, station_name,
    arr_delay, dep_delay, reported_cancelled, cancelled"""
PATTERN = "de:NET:.*(1|3|17).*"


@query("J1 P10 S15 T12", f"""
  SELECT {VIEW} FROM journeys LEFT JOIN lines USING (line_id_short) WHERE bundle LIKE '%Bündel 1%'""")
def bundle_journeys_by_part(spark, sf):
    return bundles.journeys_of_bundle(st.journeys(spark, sf), st.lines(spark, sf), "Bündel 1")


@query("J2 P11 S15 T12", f"""
  SELECT {STOP_VIEW} FROM stop_events LEFT JOIN lines USING (line_id_short)
  WHERE bundle = 'Bündel 1' AND operating_day BETWEEN DATE '1999-06-15' - 400 AND DATE '1999-06-15'""")
def bundle_stops_by_name(spark, sf):
    stops, lines = st.stop_events(spark, sf), st.lines(spark, sf)
    return bundles.stops_of_bundle(stops, lines, "Bündel 1", "1999-06-15", 400)


@query("J3", """
  SELECT operating_day::text AS operating_day, journey_no, line_id, bundle, tier
  FROM journeys JOIN lines USING (line_id_short)""")
def journeys_with_lines(spark, sf):
    return every_bundle(spark, sf).select("operating_day", "journey_no", "line_id", "bundle", "tier")


@query("J8 P10", """
  SELECT report_bundle, bundle, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt
  FROM (SELECT report_bundle, r.bundle, has_realtime FROM journeys JOIN reports r USING (line_id_short))
  GROUP BY ALL""")
def nested_bundle_journeys(spark, sf):
    chosen = bundles.lines_by_report(st.lines(spark, sf))
    return (
        st.journeys(spark, sf)
        .join(chosen, "line_id_short")
        .groupBy("report_bundle", "bundle")
        .agg(F.count("*").alias("total"), F.count_if("has_realtime").alias("total_rt"))
    )


@query("A13 P6", """
  SELECT DISTINCT operating_day::text AS operating_day, tier, line_short, journey_no, has_realtime
  FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' AND has_realtime = false""")
def without_realtime(spark, sf):
    return extras.without_realtime(every_bundle(spark, sf), AS_OF, SPAN)


@query("A13 P13 T13", """
  SELECT DISTINCT operating_day::text AS operating_day, line_short, line_id, journey_no, operator
  FROM extras WHERE line_id SIMILAR TO 'de:NET:.*(1|3|17).*' AND operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01'""")
def extra_journeys(spark, sf):
    return extras.extra_journeys(st.extras(spark, sf), AS_OF, SPAN, PATTERN)


MATCHED = """
  , missing AS (
    SELECT DISTINCT operating_day, tier, line_short, journey_no, has_realtime
    FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' AND has_realtime = false),
  extra_runs AS (
    SELECT DISTINCT operating_day, line_short, line_id, journey_no, operator
    FROM extras WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01'),
  matched AS (
    SELECT m.*, e.line_short AS extra_line_short, e.line_id AS extra_line_id, e.operator AS extra_operator
    FROM missing m LEFT JOIN extra_runs e ON m.operating_day = e.operating_day AND m.journey_no = e.journey_no)
"""


def _missing_and_extras(spark, sf):
    missing = extras.without_realtime(every_bundle(spark, sf), AS_OF, SPAN)
    return missing, extras.extra_journeys(st.extras(spark, sf), AS_OF, SPAN)


@query("J6", MATCHED + """
  SELECT operating_day::text AS operating_day, tier, line_short, journey_no, has_realtime,
    extra_line_short, extra_line_id, extra_operator FROM matched""")
def matched_extras(spark, sf):
    return extras.match_extras(*_missing_and_extras(spark, sf))


@query("P17 J6", MATCHED + """
  SELECT operating_day::text AS operating_day, tier, line_short, journey_no, has_realtime,
    extra_line_short, extra_line_id, extra_operator FROM matched WHERE extra_operator IS NOT NULL""")
def only_matched_extras(spark, sf):
    return extras.only_matched(extras.match_extras(*_missing_and_extras(spark, sf)))


@query("A19 J6 T15", MATCHED + """
  SELECT line_short, journey_no, min(operating_day)::text AS first_day, max(operating_day)::text AS last_day,
    count(operating_day) AS days_missing FROM matched GROUP BY line_short, journey_no""")
def missing_days_per_journey(spark, sf):
    return extras.missing_days_per_journey(*_missing_and_extras(spark, sf))


def customer_bundles(spark, sf):
    return st.table(spark, sf, "customer").select(F.concat(F.lit("Bündel Süd "), "c_custkey").alias("bundle"))


def supplier_targets(spark, sf):
    key = F.col("s_suppkey")
    return st.table(spark, sf, "supplier").select(
        F.concat(F.lit("buendel_sued_"), key).alias("slug"),
        F.concat(F.lit("https://example.org/p/"), key % 7).alias("project_url"),
        (key + 1000).cast("int").alias("folder_id"),
    )


TARGETS = """
  , bundles AS (
    SELECT 'Bündel Süd ' || c_custkey AS bundle,
      lower(replace(replace(replace('Bündel Süd ' || c_custkey, 'ü', 'ue'), 'ä', 'ae'), ' ', '_')) AS slug
    FROM customer),
  targets AS (
    SELECT 'buendel_sued_' || s_suppkey AS slug, 'https://example.org/p/' || (s_suppkey % 7) AS project_url,
      (s_suppkey + 1000)::int AS folder_id FROM supplier)
"""


@query("J7 P22", TARGETS + "SELECT slug, bundle, project_url, folder_id FROM bundles JOIN targets USING (slug)")
def published_bundles(spark, sf):
    return bundles.published(customer_bundles(spark, sf), supplier_targets(spark, sf))


@query("J7", TARGETS + "SELECT slug, bundle FROM bundles ANTI JOIN targets USING (slug)")
def unpublished_bundles(spark, sf):
    return bundles.unpublished(customer_bundles(spark, sf), supplier_targets(spark, sf))


@query("S6 P1 P2 P5", """
  SELECT l.line, l.bundle, '' AS rt_operator, l.tier, l.line_id_short, l.id, count(j.journey_no) AS journeys
  FROM lines l LEFT JOIN journeys j USING (line_id_short) GROUP BY ALL""")
def active_lines(spark, sf):
    lines = master.active_lines(st.raw_lines(spark, sf), rt_operator=True)
    # counted by line before the join
    per_line = st.journeys(spark, sf).groupBy("line_id_short").agg(F.count("journey_no").alias("n"))
    return lines.join(per_line, "line_id_short", "left").select(
        "line", "bundle", "rt_operator", "tier", "line_id_short", "id",
        F.coalesce("n", F.lit(0)).alias("journeys"),
    )


@query("A15 O4", "SELECT DISTINCT bundle FROM known_journeys WHERE bundle NOT IN ('nahsh')")
def sorted_bundle_list(spark, sf):
    return listing.sorted_distinct(bundles.bundle_list(every_bundle(spark, sf)), "bundle")


@query("A15", "SELECT DISTINCT line_id, line_id_short FROM journeys")
def distinct_line_ids(spark, sf):
    return st.journeys(spark, sf).select("line_id", "line_id_short").distinct()


@query("A15 O2", "SELECT DISTINCT operating_day::text AS operating_day FROM stop_reports")
def sorted_days(spark, sf):
    return listing.sorted_distinct(st.stop_reports(spark, sf), "operating_day")



@query("O1 O3", """
  SELECT operator, line_short, count(*) AS total FROM journeys GROUP BY ALL
  ORDER BY operator ASC NULLS LAST, total DESC, line_short LIMIT 20""")
def first_groups_in_order(spark, sf):
    counts = st.journeys(spark, sf).groupBy("operator", "line_short").agg(F.count("*").alias("total"))
    return listing.first_rows(counts, 20, "operator", "-total", "line_short")


@query("O2 O3", """
  SELECT operating_day::text AS operating_day, journey_no, line_id FROM journeys
  ORDER BY operating_day DESC, journey_no, line_id LIMIT 25""")
def latest_journeys(spark, sf):
    top = listing.first_rows(st.journeys(spark, sf), 25, "-operating_day", "journey_no", "line_id")
    return top.select("operating_day", "journey_no", "line_id")


@query("O3", """
  SELECT DISTINCT bundle FROM known_journeys WHERE bundle NOT IN ('nahsh') ORDER BY bundle LIMIT 1 OFFSET 8""")
def bundle_at_place(spark, sf):
    return listing.first_rows(bundles.bundle_list(every_bundle(spark, sf)), 1, "bundle", skip=8)


@query("P3", """
  SELECT line_id AS led_line_id, line_id_short AS led_short, operating_day::text AS operating_day, journey_no,
    has_realtime, line_id, line_id_short FROM journeys""")
def star_with_leading_columns(spark, sf):
    few = st.journeys(spark, sf).select("operating_day", "journey_no", "has_realtime", "line_id", "line_id_short")
    return listing.star_with(few, led_line_id="line_id", led_short="line_id_short")


def _sheet(spark, sf, name, span=SPAN):
    """One sheet; only the input it is made of is joined to the lines."""
    lines, stops = st.lines(spark, sf), name == "stop_events"
    return bundle_sheet(
        name,
        None if stops else bundles.journeys_by_report(st.journeys(spark, sf), lines),
        bundles.stops_by_report(st.stop_events(spark, sf), lines) if stops else None,
        extras.extra_journeys(st.extras(spark, sf), AS_OF, span),
        AS_OF, span, span, city_bundles=("Bündel 4", "Bündel 9"),
    )


@query("S16 A26 C20 J8", f"""
  , sheet AS (
    SELECT report_bundle, operating_day::text AS operating_day, tier_group, count(*)::int AS total,
      (count(*) FILTER (ever_reported))::int AS total_rt, total_rt::float / total::float AS rate, {INCIDENTS} AS incidents
    FROM (SELECT *, CASE WHEN tier IN ('1+', '1', '2') THEN 'ebene_1_2' WHEN tier = '3' THEN 'ebene_3' END AS tier_group
      FROM report_journeys)
    WHERE tier_group IS NOT NULL GROUP BY report_bundle, operating_day, tier_group)
  SELECT report_bundle, operating_day, tier_group, total, total_rt, rate, incidents::bigint AS incidents, false AS is_total FROM sheet
  UNION ALL SELECT report_bundle, NULL, NULL, NULL, NULL, NULL, sum(incidents)::bigint, true FROM sheet GROUP BY report_bundle""")
def report_incidents(spark, sf):
    return _sheet(spark, sf, "incidents")


@query("S16 A24", f"""
  SELECT * FROM (PIVOT (
    SELECT report_bundle, operating_day::text AS day, tier, line_short, line_id_short, count(*) AS total,
      count(*) FILTER (ever_reported) AS total_rt, {RATE} AS rate
    FROM report_journeys WHERE operating_day BETWEEN DATE '2001-08-01' - 21 AND DATE '2001-08-01'
    GROUP BY report_bundle, operating_day, tier, line_short, line_id_short)
  ON day IN ({QUOTED_RECENT}) USING sum(rate) GROUP BY report_bundle, tier, line_short)""")
def report_line_by_day(spark, sf):
    return _sheet(spark, sf, "line_by_day", 21)


@query("S16 A8", f"""
  SELECT report_bundle, tier, line_short, journey_no, total, total_rt, total - total_rt AS missing,
    {RATE} AS rate, last_delivery::text AS last_delivery
  FROM (
    SELECT report_bundle, tier, line_short, journey_no, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt,
      max(operating_day) FILTER (ever_reported) AS last_delivery
    FROM report_journeys GROUP BY ALL)
  WHERE total - total_rt > 1 AND tier IN ('1+', '1', '2', 'Nacht')""")
def report_incomplete(spark, sf):
    return _sheet(spark, sf, "incomplete")


@query("S16 J6 P17", """
  , missing AS (
    SELECT DISTINCT report_bundle, operating_day, tier, line_short, journey_no, has_realtime
    FROM report_journeys WHERE ever_reported = false),
  extra_runs AS (SELECT DISTINCT operating_day, line_short, line_id, journey_no, operator FROM extras)
  SELECT report_bundle, m.operating_day::text AS operating_day, tier, m.line_short, m.journey_no, has_realtime,
    e.line_short AS extra_line_short, e.line_id AS extra_line_id, e.operator AS extra_operator
  FROM missing m JOIN extra_runs e ON m.operating_day = e.operating_day AND m.journey_no = e.journey_no
  WHERE e.operator IS NOT NULL""")
def report_extra_matches(spark, sf):
    return _sheet(spark, sf, "extra_matches")


@query("S16", f"SELECT report_bundle, {VIEW} FROM report_journeys")
def report_journeys(spark, sf):
    return _sheet(spark, sf, "journeys")


@query("S16 S17", f"""
  SELECT bundle AS report_bundle, {STOP_VIEW} FROM stop_events JOIN lines USING (line_id_short)
  WHERE bundle NOT IN ('nahsh') AND bundle NOT IN ('Bündel 4', 'Bündel 9')""")
def report_stop_events(spark, sf):
    return _sheet(spark, sf, "stop_events")
