"""Coverage rates, incidents, pivots and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions import days, incidents, match, numbers
from punctua.operators import bundles, coverage, pivots
from workload import standins as st
from workload.registry import query

AS_OF, SPAN = st.AS_OF, st.WHOLE_SPAN
TOP = ("1+", "1", "2", "Stadt", "Nacht")
MONTH = days.previous_month(AS_OF)
RECENT = days.last_days(AS_OF, 21)
QUOTED_RECENT = ", ".join(f"'{d}'" for d in RECENT)
QUOTED_MONTH = ", ".join(f"'{d}'" for d in days.days_between(*MONTH))
BUNDLES = [f"Bündel {n}" for n in (0, 1, 10, 11, 2, 3, 4, 5, 6, 7, 8, 9)]
WEIGHTED_RECENT = ", ".join(
    f"count(*) FILTER (day = '{d}' AND has_realtime) / nullif(count(*) FILTER (day = '{d}'), 0) AS \"{d}\"" for d in RECENT
)
RATE = "round(total_rt / total, 2)"
INCIDENTS = """CASE WHEN rate < 0.85 AND tier_group = 'ebene_1_2' THEN ((0.95 - rate) * 10)::int ELSE 0 END"""


def bundle_1(spark, sf):
    return bundles.journeys_of_bundle(st.journeys(spark, sf), st.lines(spark, sf), "Bündel 1")


def every_bundle(spark, sf):
    return bundles.with_lines(st.journeys(spark, sf), st.lines(spark, sf))


@query("A5 J3 P6 P14 O1", """
  SELECT operating_day::text AS day, bundle,
    round(count(*) FILTER (ever_reported) / count(*) * 100, 1) AS percent_rt
  FROM known_journeys
  WHERE operating_day > DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' AND tier IN ('1+', '1', '2', 'Stadt', 'Nacht')
  GROUP BY ALL""")
def bundle_coverage_by_day(spark, sf):
    journeys, lines = st.journeys(spark, sf), st.lines(spark, sf)
    return coverage.bundle_coverage_by_day(journeys, lines, TOP, AS_OF, SPAN)


@query("A1 A2 A3 P4 P7 C25 C27", """
  SELECT operator, count(operator) AS total, count(operator) FILTER (ever_reported) AS total_rt,
    count(operator) FILTER (operating_day = DATE '2001-07-31') AS day_1_total,
    count(operator) FILTER (operating_day = DATE '2001-07-31' AND ever_reported) AS day_1_rt,
    round(day_1_rt / nullif(day_1_total, 0) * 100, 2) AS day_1_percent,
    count(operator) FILTER (operating_day = DATE '2001-07-30') AS day_2_total,
    count(operator) FILTER (operating_day = DATE '2001-07-30' AND ever_reported) AS day_2_rt,
    round(day_2_rt / nullif(day_2_total, 0) * 100, 2) AS day_2_percent,
    count(operator) FILTER (operating_day = DATE '2001-07-29') AS day_3_total,
    count(operator) FILTER (operating_day = DATE '2001-07-29' AND ever_reported) AS day_3_rt,
    round(day_3_rt / nullif(day_3_total, 0) * 100, 2) AS day_3_percent
  FROM journeys GROUP BY operator""")
def operator_coverage(spark, sf):
    return coverage.operator_coverage(st.journeys(spark, sf), AS_OF)


@query("A4 P7 J3", """
  SELECT line_id_short, operating_day::text AS operating_day, bundle,
    round(count(*) FILTER (ever_reported) / count(*) * 100, 1) AS percent_rt
  FROM known_journeys WHERE operating_day = DATE '2001-07-30' GROUP BY ALL""")
def line_coverage_on_day(spark, sf):
    return coverage.line_coverage_on(st.journeys(spark, sf), st.lines(spark, sf), "2001-07-30")


@query("A6 C20 P20 T2", f"""
  SELECT operating_day::text AS operating_day, tier_group, total, total_rt, rate, {INCIDENTS} AS incidents
  FROM (
    SELECT operating_day, tier_group, sum(n)::int AS total, sum(n_rt)::int AS total_rt,
      sum(n_rt)::float / sum(n)::float AS rate
    FROM (
      SELECT operating_day, tier, count(*) AS n, count(*) FILTER (ever_reported) AS n_rt,
        CASE WHEN tier IN ('1+', '1', '2') THEN 'ebene_1_2' WHEN tier = '3' THEN 'ebene_3' ELSE 'andere' END AS tier_group
      FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' GROUP BY ALL)
    WHERE tier_group IN ('ebene_1_2', 'ebene_3') GROUP BY ALL)""")
def incidents_by_day(spark, sf):
    return coverage.incidents_by_day(every_bundle(spark, sf), AS_OF, SPAN)


@query("C20 C21 C22 P20 A6", """
  , groups AS (
    SELECT journey_no, CASE WHEN tier IN ('1+', '1', '2') THEN '1_2' ELSE tier END AS tier_group,
      count(*) AS total, count(*) FILTER (ever_reported) AS total_rt
    FROM known_journeys GROUP BY ALL),
  rates AS (SELECT *, total - total_rt AS missing, total_rt / total AS rate FROM groups)
  SELECT journey_no, tier_group, total, missing, rate,
    CASE WHEN tier_group = '1_2' AND rate::float < 0.85
      THEN ((0.95 - rate::float) * 10)::int ELSE 0 END AS report_form,
    CASE WHEN tier_group = '1_2' AND rate < 0.85::double
      THEN least(trunc((1 - 0.05::double - rate) * 10)::bigint, missing) ELSE 0 END AS contract_form,
    CASE WHEN tier_group = '1_2' AND rate < 0.85::double
      THEN least(trunc((1 - 0.05::double - rate) * 10)::bigint, missing)
      WHEN tier_group = '3' AND rate < 0.75::double
      THEN least(trunc((1 - 0.15::double - rate) * 10)::bigint, total) ELSE 0 END AS virtual_form
  FROM rates""")
def incident_forms(spark, sf):
    group, rate = F.col("tier_group"), F.col("rate")
    total, missing = F.col("total"), F.col("missing")
    report_group = F.when(group == "1_2", F.lit("ebene_1_2")).otherwise(group)
    return (
        every_bundle(spark, sf)
        .groupBy("journey_no", incidents.tier_short(F.col("tier")).alias("tier_group"))
        .agg(F.count("*").alias("total"), F.count_if("ever_reported").alias("total_rt"))
        .withColumn("missing", total - F.col("total_rt"))
        .withColumn("rate", numbers.ratio(F.col("total_rt"), total))
        .select(
            "journey_no", group, total, missing, rate,
            incidents.report_incidents(report_group, rate).alias("report_form"),
            incidents.contract_incidents(group, rate, missing).alias("contract_form"),
            incidents.virtual_incidents(group, rate, total, missing).alias("virtual_form"),
        )
    )


@query("A6 C21 C22 P20", """
  , groups AS (
    SELECT operating_day, CASE WHEN tier IN ('1+', '1', '2') THEN '1_2' ELSE tier END AS tier_group,
      count(*) AS total, count(*) FILTER (ever_reported) AS total_rt
    FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' GROUP BY ALL),
  rates AS (SELECT *, total - total_rt AS missing, total_rt / total AS rate FROM groups)
  SELECT operating_day::text AS operating_day, tier_group, total, total_rt, missing, rate,
    CASE WHEN tier_group = '1_2' AND rate < 0.85::double
      THEN least(trunc((1 - 0.05::double - rate) * 10)::bigint, missing) ELSE 0 END AS incidents,
    CASE WHEN tier_group = '1_2' AND rate < 0.85::double
      THEN least(trunc((1 - 0.05::double - rate) * 10)::bigint, missing)
      WHEN tier_group = '3' AND rate < 0.75::double
      THEN least(trunc((1 - 0.15::double - rate) * 10)::bigint, total) ELSE 0 END AS virtual
  FROM rates""")
def contract_incidents_by_day(spark, sf):
    return coverage.contract_incidents_by_day(every_bundle(spark, sf), AS_OF, SPAN)


@query("A7 A8 P4 P15 C25", f"""
  SELECT tier, line_short, journey_no, total, total_rt, total - total_rt AS missing,
    {RATE} AS rate, last_delivery::text AS last_delivery
  FROM (
    SELECT tier, line_short, journey_no, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt,
      max(operating_day) FILTER (has_realtime) AS last_delivery
    FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' GROUP BY ALL)
  WHERE total - total_rt > 1 AND tier IN ('1+', '1', '2')""")
def incomplete_journeys(spark, sf):
    return coverage.incomplete_journeys(every_bundle(spark, sf), AS_OF, SPAN)


@query("A7 A8", f"""
  SELECT tier, line_short, journey_no, total, total_rt, total - total_rt AS missing,
    {RATE} AS rate, last_delivery::text AS last_delivery
  FROM (
    SELECT tier, line_short, journey_no, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt,
      max(operating_day) FILTER (ever_reported) AS last_delivery
    FROM known_journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' GROUP BY ALL)
  WHERE total - total_rt > 1 AND tier IN ('1+', '1', '2', 'Nacht')""")
def incomplete_journeys_by_ever_reported(spark, sf):
    return coverage.incomplete_journeys(
        every_bundle(spark, sf), AS_OF, SPAN, ("1+", "1", "2", "Nacht"), "ever_reported"
    )


@query("A9 P13 P15", """
  SELECT line_short, journey_no, min(operating_day)::text AS first_day, max(operating_day)::text AS last_day,
    count(*) AS total, count(*) FILTER (has_realtime = false) AS missing, missing / count(*) AS missing_share
  FROM journeys
  WHERE line_id SIMILAR TO '.*(:3:|:17:|:22:).*' AND operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01'
  GROUP BY line_short, journey_no HAVING count(*) FILTER (has_realtime = false) > 1""")
def missing_share_by_journey(spark, sf):
    return coverage.missing_share(st.journeys(spark, sf), AS_OF, SPAN, ".*(:3:|:17:|:22:).*")


@query("A10 P15", """
  SELECT line_short, min(operating_day)::text AS first_day, max(operating_day)::text AS last_day,
    count(*) AS total, count(*) FILTER (has_realtime = false) AS missing, missing / count(*) AS missing_share
  FROM journeys WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01'
  GROUP BY line_short HAVING count(*) FILTER (has_realtime = false) > 1""")
def missing_share_by_line(spark, sf):
    return coverage.missing_share(st.journeys(spark, sf), AS_OF, SPAN, by_journey=False)


@query("A12 A7 P8 C25", f"""
  SELECT operating_day::text AS operating_day, tier, line_short, line_id_short, count(*) AS total,
    count(*) FILTER (has_realtime) AS total_rt, {RATE} AS rate,
    (max(operating_day) FILTER (has_realtime))::text AS last_delivery
  FROM known_journeys
  WHERE operating_day BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'
  GROUP BY operating_day, tier, line_short, line_id_short""")
def line_coverage_previous_month(spark, sf):
    return coverage.line_coverage_by_day(every_bundle(spark, sf), *MONTH)


@query("A12", f"""
  SELECT operating_day::text AS operating_day, tier, line_short, line_id_short, count(*) AS total,
    count(*) FILTER (ever_reported) AS total_rt, {RATE} AS rate,
    (max(operating_day) FILTER (ever_reported))::text AS last_delivery
  FROM known_journeys GROUP BY operating_day, tier, line_short, line_id_short""")
def line_coverage_all_days(spark, sf):
    return coverage.line_coverage_by_day(every_bundle(spark, sf), "1990-01-01", AS_OF, "ever_reported")


@query("A14 P6 O1", """
  SELECT DISTINCT line_id_short, client_id, max(operating_day)::text AS last_day FROM journeys
  WHERE operating_day >= DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' GROUP BY ALL""")
def latest_day_per_client(spark, sf):
    return coverage.latest_day_per_client(st.journeys(spark, sf), AS_OF, SPAN)


@query("A17", "SELECT count(*) AS total FROM journeys")
def journey_count(spark, sf):
    return coverage.journey_count(st.journeys(spark, sf))


@query("A18", """
  SELECT min(operating_day)::text AS first_day, max(operating_day)::text AS last_day, count(*) AS total
  FROM journeys""")
def journey_span(spark, sf):
    return coverage.journey_span(st.journeys(spark, sf))


@query("A23", """
  SELECT line_short, round_even(count(*) FILTER (has_realtime) / count(*) * 100, 0) AS percent_rt
  FROM journeys GROUP BY ALL""")
def line_share(spark, sf):
    return coverage.line_share(st.journeys(spark, sf))


@query("A24 T9", f"""
  SELECT * FROM (PIVOT (
    SELECT operating_day::text AS day, tier, line_short, line_id_short, count(*) AS total,
      count(*) FILTER (has_realtime) AS total_rt, {RATE} AS rate
    FROM known_journeys WHERE operating_day BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'
    GROUP BY operating_day, tier, line_short, line_id_short)
  ON day IN ({QUOTED_MONTH}) USING sum(rate) GROUP BY tier, line_short)""")
def pivot_line_by_day(spark, sf):
    rates = coverage.line_coverage_by_day(every_bundle(spark, sf), *MONTH)
    return pivots.line_by_day(rates, days.days_between(*MONTH))


@query("A24 T9", f"""
  SELECT tier, line_short, {WEIGHTED_RECENT}
  FROM (SELECT tier, line_short, operating_day::text AS day, has_realtime FROM known_journeys
    WHERE operating_day BETWEEN DATE '{RECENT[0]}' AND DATE '{RECENT[-1]}') GROUP BY tier, line_short""")
def pivot_line_by_day_weighted(spark, sf):
    rates = coverage.line_coverage_by_day(every_bundle(spark, sf), RECENT[0], RECENT[-1])
    return pivots.weighted_line_by_day(rates, RECENT)


@query("A25 A5", f"""
  SELECT * FROM (PIVOT (
    SELECT operating_day::text AS day, bundle,
      round(count(*) FILTER (ever_reported) / count(*) * 100, 1) AS percent_rt
    FROM known_journeys
    WHERE operating_day > DATE '2001-08-01' - 2500 AND operating_day <= DATE '2001-08-01' AND tier IN ('1+', '1', '2', 'Stadt', 'Nacht')
    GROUP BY operating_day, bundle)
  ON bundle IN ({", ".join(f"'{b}'" for b in BUNDLES)}) USING first(percent_rt) GROUP BY day)""")
def pivot_day_by_bundle(spark, sf):
    rates = bundle_coverage_by_day(spark, sf)
    return pivots.day_by_bundle(rates, BUNDLES)


@query("A26 A6", f"""
  , sheet AS (
    SELECT operating_day::text AS operating_day, tier_group, count(*)::int AS total,
      (count(*) FILTER (ever_reported))::int AS total_rt, total_rt::float / total::float AS rate, {INCIDENTS} AS incidents
    FROM (SELECT *, CASE WHEN tier IN ('1+', '1', '2') THEN 'ebene_1_2' WHEN tier = '3' THEN 'ebene_3' END AS tier_group
      FROM known_journeys)
    WHERE tier_group IS NOT NULL GROUP BY operating_day, tier_group)
  SELECT operating_day, tier_group, total, total_rt, rate, incidents::bigint AS incidents, false AS is_total FROM sheet
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, sum(incidents)::bigint, true FROM sheet""")
def incidents_with_total(spark, sf):
    sheet = coverage.incidents_by_day(every_bundle(spark, sf), AS_OF, SPAN, ordered=False)
    return pivots.with_total_row(sheet, ("operating_day", "tier_group"), "incidents")


@query("P4 A16", """
  SELECT line_short, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt,
    total - total_rt AS missing, missing / count(*) AS missing_share
  FROM journeys GROUP BY line_short""")
def lateral_alias_shares(spark, sf):
    return spark.sql(
        """
        SELECT line_short, count(*) AS total, count_if(has_realtime) AS total_rt,
          total - total_rt AS missing, missing / count(*) AS missing_share
        FROM {journeys} GROUP BY line_short
        """,
        journeys=st.journeys(spark, sf),
    )


@query("A16 A2", """
  SELECT operating_day::text AS operating_day, line_id_short, count(*) AS total,
    count(*) FILTER (has_realtime) AS total_rt
  FROM journeys GROUP BY ALL""")
def group_by_all(spark, sf):
    return spark.sql(
        """
        SELECT operating_day, line_id_short, count(*) AS total,
          count(*) FILTER (WHERE has_realtime) AS total_rt
        FROM {journeys} GROUP BY ALL
        """,
        journeys=st.journeys(spark, sf),
    )


@query("A2 A3", """
  SELECT operator, count(operator) AS named, count(*) AS total,
    count(*) FILTER (has_realtime) AS total_rt, count(operator) FILTER (has_realtime) AS named_rt,
    count(*) FILTER (operator <> '2-HIGH') AS not_high
  FROM journeys GROUP BY ALL""")
def filtered_counts(spark, sf):
    return st.journeys(spark, sf).groupBy("operator").agg(
        F.count("operator").alias("named"),
        F.count("*").alias("total"),
        F.count_if("has_realtime").alias("total_rt"),
        F.count(F.when(F.col("has_realtime"), F.col("operator"))).alias("named_rt"),
        F.count_if(F.col("operator") != "2-HIGH").alias("not_high"),
    )


@query("P20 C22", """
  SELECT tier, CASE WHEN tier IN ('1+', '1', '2') THEN 'ebene_1_2' WHEN tier = '3' THEN 'ebene_3' ELSE 'andere' END AS tier_group,
    CASE WHEN tier IN ('1+', '1', '2') THEN '1_2' ELSE tier END AS tier_short, count(*) AS total
  FROM known_journeys GROUP BY ALL""")
def tier_groups(spark, sf):
    tier = F.col("tier")
    return (
        every_bundle(spark, sf)
        .groupBy("tier", incidents.tier_group(tier).alias("tier_group"), incidents.tier_short(tier).alias("tier_short"))
        .agg(F.count("*").alias("total"))
    )


@query("P6", """
  SELECT line_short,
    count(*) FILTER (operating_day >= DATE '2001-08-01' - 7 AND operating_day <= DATE '2001-08-01') AS last_7,
    count(*) FILTER (operating_day >= DATE '2001-08-01' - 21 AND operating_day <= DATE '2001-08-01') AS last_21,
    count(*) FILTER (operating_day >= DATE '2001-08-01' - 28 AND operating_day <= DATE '2001-08-01') AS last_28,
    count(*) FILTER (operating_day >= DATE '2001-08-01' - 30 AND operating_day <= DATE '2001-08-01') AS last_30,
    count(*) FILTER (operating_day >= DATE '2001-08-01' - 35 AND operating_day <= DATE '2001-08-01') AS last_35,
    count(*) FILTER (operating_day > DATE '2001-08-01' - 28 AND operating_day <= DATE '2001-08-01') AS after_28,
    count(*) FILTER (operating_day > DATE '2001-08-01' - 60 AND operating_day <= DATE '2001-08-01') AS after_60,
    count(*) AS total
  FROM journeys GROUP BY ALL""")
def rolling_window_counts(spark, sf):
    day = F.col("operating_day")
    counts = [F.count_if(days.in_last_days(day, AS_OF, n)).alias(f"last_{n}") for n in (7, 21, 28, 30, 35)]
    counts += [F.count_if(days.in_last_days(day, AS_OF, n, strict=True)).alias(f"after_{n}") for n in (28, 60)]
    return st.journeys(spark, sf).groupBy("line_short").agg(*counts, F.count("*").alias("total"))


@query("P6", """
  SELECT operating_day::text AS operating_day, journey_no, line_id FROM journeys
  WHERE operating_day >= DATE '2001-08-01' - interval '365 days' AND operating_day <= DATE '2001-08-01'""")
def rolling_window_rows(spark, sf):
    recent = st.journeys(spark, sf).where(days.in_last_days(F.col("operating_day"), AS_OF, 365))
    return recent.select("operating_day", "journey_no", "line_id")


@query("P6 A6 C20", f"""
  SELECT operating_day::text AS operating_day, tier_group, count(*)::int AS total,
    (count(*) FILTER (ever_reported))::int AS total_rt, total_rt::float / total::float AS rate, {INCIDENTS} AS incidents
  FROM (SELECT *, CASE WHEN tier IN ('1+', '1', '2') THEN 'ebene_1_2' WHEN tier = '3' THEN 'ebene_3' END AS tier_group
    FROM known_journeys WHERE operating_day BETWEEN DATE '1998-06-15' - 300 AND DATE '1998-06-15')
  WHERE tier_group IS NOT NULL GROUP BY operating_day, tier_group""")
def incidents_of_a_past_date(spark, sf):
    """Days after ``as_of`` are in the table and do not count."""
    return coverage.incidents_by_day(every_bundle(spark, sf), "1998-06-15", 300, ordered=False)


@query("P7", "SELECT operating_day::text AS operating_day, journey_no, line_id, has_realtime FROM journeys WHERE operating_day = DATE '2001-07-31'")
def single_day_rows(spark, sf):
    day = st.journeys(spark, sf).where(days.on_day(F.col("operating_day"), AS_OF, 1))
    return day.select("operating_day", "journey_no", "line_id", "has_realtime")


@query("P8", f"""
  SELECT operating_day::text AS operating_day, journey_no, line_id FROM journeys
  WHERE operating_day BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'""")
def previous_month_rows(spark, sf):
    month = st.journeys(spark, sf).where(days.in_previous_month(F.col("operating_day"), AS_OF))
    return month.select("operating_day", "journey_no", "line_id")


@query("P9", """
  SELECT DISTINCT journey_no FROM journeys
  WHERE operating_day >= DATE '1996-01-01' AND operating_day <= DATE '2000-12-31'""")
def day_range_journeys(spark, sf):
    span = st.journeys(spark, sf).where(days.in_range(F.col("operating_day"), "1996-01-01", "2000-12-31"))
    return span.select("journey_no").distinct()


@query("P12 P3", """
  SELECT line_id AS led_by_line, line_id_short AS led_by_short, operating_day::text AS operating_day, journey_no, line_id
  FROM journeys WHERE line_id LIKE 'de:NET:1_:%'""")
def like_wildcards(spark, sf):
    return (
        st.journeys(spark, sf)
        .where(F.col("line_id").like("de:NET:1_:%"))
        .select(F.col("line_id").alias("led_by_line"), F.col("line_id_short").alias("led_by_short"),
                "operating_day", "journey_no", "line_id")
    )


@query("P13", "SELECT operating_day::text AS operating_day, journey_no, line_id FROM extras WHERE line_id SIMILAR TO 'de:NET:(3|17|22):.*'")
def full_match_lines(spark, sf):
    chosen = st.extras(spark, sf).where(match.full_match(F.col("line_id"), "de:NET:(3|17|22):.*"))
    return chosen.select("operating_day", "journey_no", "line_id")


@query("P14", """
  SELECT tier, bundle, count(*) AS total FROM known_journeys
  WHERE tier IN ('1+', '3', 'Nacht') AND bundle NOT IN ('nahsh') GROUP BY ALL""")
def tier_membership(spark, sf):
    return (
        every_bundle(spark, sf)
        .where(match.any_of(F.col("tier"), ("1+", "3", "Nacht")) & match.none_of(F.col("bundle"), bundles.UNREPORTED))
        .groupBy("tier", "bundle")
        .agg(F.count("*").alias("total"))
    )


@query("P14", "SELECT operator, journey_no, operating_day::text AS operating_day FROM journeys WHERE operator NOT IN ('1-URGENT')")
def exclusion_drops_nulls(spark, sf):
    kept = st.journeys(spark, sf).where(match.none_of(F.col("operator"), ("1-URGENT",)))
    return kept.select("operator", "journey_no", "operating_day")


@query("P21", "SELECT line_short, has_realtime, count(*) AS total FROM journeys WHERE line_short IN ('L3', 'L5') GROUP BY ALL")
def filter_by_sql_text(spark, sf):
    chosen = st.journeys(spark, sf).filter("line_short in ('L3', 'L5')")
    return chosen.groupBy("line_short", "has_realtime").agg(F.count("*").alias("total"))
