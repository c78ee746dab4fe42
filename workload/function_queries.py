"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions import days, numbers, text
from workload import standins as st
from workload.registry import query

# ids with all, too few and no parts
RAGGED = """CASE o_orderkey % 4 WHEN 0 THEN 'de:NET' WHEN 1 THEN NULL WHEN 2 THEN 'de:NET:' || o_custkey
  ELSE 'de:NET:' || o_custkey || ':1:R' END"""


def ragged():
    key, full = F.col("o_orderkey"), F.concat(F.lit("de:NET:"), "o_custkey")
    return (
        F.when(key % 4 == 0, F.lit("de:NET"))
        .when(key % 4 == 1, None)
        .when(key % 4 == 2, full)
        .otherwise(F.concat(full, F.lit(":1:R")))
    )


@query("C1", f"""
  SELECT o_orderkey, concat_ws(':', split_part(id, ':', 1), split_part(id, ':', 2), split_part(id, ':', 3)) AS line_id_short
  FROM (SELECT o_orderkey, coalesce({RAGGED}, NULL) AS id FROM orders)""", prelude=False)
def line_ids_padded(spark, sf):
    return st.table(spark, sf, "orders").select("o_orderkey", text.line_id_padded(ragged()).alias("line_id_short"))


@query("C2", f"""
  SELECT o_orderkey, array_to_string(string_split({RAGGED}, ':')[1:3], ':') AS line_id_short FROM orders""", prelude=False)
def line_ids_prefix(spark, sf):
    return st.table(spark, sf, "orders").select("o_orderkey", text.line_id_prefix(ragged()).alias("line_id_short"))


@query("C3", """
  SELECT device_id, CASE WHEN len(string_split(device_id, '#')) >= 3 THEN string_split(device_id, '#')[3] ELSE '-' END AS client_id,
    count(*) AS total FROM journeys GROUP BY ALL""")
def client_ids(spark, sf):
    device = F.col("device_id")
    return (
        st.journeys(spark, sf)
        .groupBy("device_id", text.client_id(device).alias("client_id"))
        .agg(F.count("*").alias("total"))
    )


@query("C4", "SELECT coalesce(operator, '') AS operator, count(*) AS total FROM journeys GROUP BY 1")
def text_or_empty(spark, sf):
    filled = st.journeys(spark, sf).select(text.text_or_empty(F.col("operator")).alias("operator"))
    return filled.groupBy("operator").agg(F.count("*").alias("total"))


@query("C5 T17", """
  SELECT l_orderkey, l_linenumber, try_cast(t AS double) AS delay, count(*) AS total
  FROM (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN NULL ELSE l_quantity::int::text END AS t FROM lineitem)
  GROUP BY ALL""", prelude=False)
def numbers_or_null(spark, sf):
    flag = F.col("l_returnflag")
    raw = F.when(flag == "A", "").when(flag == "N", None).otherwise(F.col("l_quantity").cast("int").cast("string"))
    return (
        st.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber", numbers.number_or_null(raw).alias("delay"))
        .agg(F.count("*").alias("total"))
    )


@query("C6", """
  SELECT o_orderkey, coalesce(lower(CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'false' ELSE NULL END) = 'true', false) AS flag
  FROM orders""", prelude=False)
def text_flags(spark, sf):
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", "True").when(status == "O", "false")
    return st.table(spark, sf, "orders").select("o_orderkey", numbers.flag(raw).alias("flag"))


@query("C7", """
  SELECT journey_no, line_id, operating_day::text AS operating_day, length(ts_reported_cancelled) > 0 AS reported,
    length(ts_reported_cancelled) > 0 OR journey_cancelled AS cancelled_any FROM journeys""")
def cancellation_flags(spark, sf):
    reported = numbers.reported_flag(F.col("ts_reported_cancelled"))
    return st.journeys(spark, sf).select(
        "journey_no", "line_id", "operating_day", reported.alias("reported"),
        numbers.cancelled_any(reported, F.col("journey_cancelled")).alias("cancelled_any"),
    )


@query("C8", """
  SELECT sched_dep, CASE WHEN length(sched_dep) > 10 THEN substr(sched_dep, 9, 2) || ':' || substr(sched_dep, 11, 2) ELSE '' END AS clock,
    count(*) AS total FROM delay_reports GROUP BY ALL""")
def clock_texts(spark, sf):
    return (
        st.delay_reports(spark, sf)
        .groupBy("sched_dep", text.clock_text(F.col("sched_dep")).alias("clock"))
        .agg(F.count("*").alias("total"))
    )


@query("C10", """
  SELECT l_orderkey, l_linenumber, l_partkey, strftime(timezone('Europe/Berlin', timezone('UTC',
    l_shipdate::date::timestamp + to_seconds(l_partkey * 11 % 86400))), '%Y-%m-%d %H:%M:%S') AS reported_at
  FROM lineitem""", prelude=False)
def local_report_times(spark, sf):
    seconds = F.unix_date(F.to_date("l_shipdate")) * F.lit(86400) + F.col("l_partkey") * 11 % 86400
    return st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", days.local_text(F.timestamp_seconds(seconds)).alias("reported_at")
    )


@query("C9 C11", """
  SELECT o_orderkey, o_orderdate::date::text AS operating_day, strftime(o_orderdate::date + time '06:30:15', '%Y-%m-%d %H:%M:%S') AS departure,
    hour(o_orderdate::date + time '06:30:15')::int AS hour FROM orders""", prelude=False)
def iso_texts_to_days(spark, sf):
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T06:30:15+02:00"))
    wall = days.wall_time(iso)
    return st.table(spark, sf, "orders").select(
        "o_orderkey", days.day_of(iso).alias("operating_day"), wall.alias("departure"), F.hour(wall).alias("hour")
    )


@query("C12", """
  SELECT s_suppkey, (s_suppkey * 1237 + 52000000) / 1000000 AS lat FROM supplier""", prelude=False)
def micro_degrees(spark, sf):
    micro = (F.col("s_suppkey") * 1237 + 52000000).cast("string")
    return st.table(spark, sf, "supplier").select("s_suppkey", numbers.degrees(micro).alias("lat"))


NAME = "'Größe Öl ' || ['Süd', 'Wäsche', 'Straße', 'ÄÖÜ'][o_orderkey % 4 + 1] || ' ' || o_custkey"


def german_name():
    words = F.array(*[F.lit(w) for w in ("Süd", "Wäsche", "Straße", "ÄÖÜ")])
    return F.concat(F.lit("Größe Öl "), F.get(words, (F.col("o_orderkey") % 4).cast("int")), F.lit(" "), "o_custkey")


@query("C13", f"""
  SELECT o_orderkey, plain, lower(replace(plain, ' ', '_')) AS slug FROM (
    SELECT o_orderkey, replace(replace(replace(replace(replace(replace(replace({NAME}, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'),
      'Ä', 'Ae'), 'Ö', 'Oe'), 'Ü', 'Ue'), 'ß', 'ss') AS plain FROM orders)""", prelude=False)
def slugs(spark, sf):
    name = german_name()
    return st.table(spark, sf, "orders").select(
        "o_orderkey", text.transliterate(name).alias("plain"), text.slug(name).alias("slug")
    )


@query("C24", f"""
  SELECT o_orderkey, (1000 + list_sum(list_transform(list_filter(string_split(
    replace(replace(replace(lower({NAME}), 'ü', 'ue'), 'ä', 'ae'), 'ö', 'oe'), ''),
    lambda c: c BETWEEN 'a' AND 'z'), lambda c: ascii(c) - 97)))::bigint::text AS code FROM orders""", prelude=False)
def letter_codes(spark, sf):
    return st.table(spark, sf, "orders").select("o_orderkey", text.letter_code(german_name()).alias("code"))


@query("C14", """
  SELECT station_name, idx, left(CASE WHEN contains(station_name, ' ') AND substr(station_name, strpos(station_name, ' ') + 1) <> ''
      THEN substr(station_name, strpos(station_name, ' ') + 1) ELSE split_part(station_name, ' ', 1) END, 8) AS label, count(*) AS total
  FROM stop_reports GROUP BY ALL""")
def stop_name_labels(spark, sf):
    return (
        st.stop_reports(spark, sf)
        .groupBy("station_name", "idx", text.stop_label(F.col("station_name")).alias("label"))
        .agg(F.count("*").alias("total"))
    )


SHARES = """
  , shares AS (SELECT journey_no, count(*) AS total, count(*) FILTER (has_realtime) AS total_rt FROM journeys GROUP BY ALL)
"""


def shares(spark, sf):
    grouped = st.journeys(spark, sf).groupBy("journey_no")
    return grouped.agg(F.count("*").alias("total"), F.count_if("has_realtime").alias("total_rt"))


@query("C15", SHARES + """
  SELECT journey_no, CASE WHEN total_rt = 0 THEN '-' ELSE
    printf('%.1f%%', trunc((1 - total_rt / total) * 1000)::bigint / 10.0::double) END AS missing FROM shares""")
def complement_percents(spark, sf):
    # the report marks a journey without any delivery by -1
    share = F.when(F.col("total_rt") == 0, -1.0).otherwise(numbers.ratio(F.col("total_rt"), F.col("total")))
    return shares(spark, sf).select("journey_no", text.complement_percent(share).alias("missing"))


@query("C25 C27 T3 T4", SHARES + """
  SELECT journey_no, round(total_rt / total, 2) AS rate, round(total_rt / total * 100, 1) AS percent_1,
    round(total_rt / total * 100, 2) AS percent_2, round(total_rt / total * 100, 0) AS percent_0,
    total / nullif(total - total_rt, 0) AS per_missing
  FROM shares""")
def rounded_rates(spark, sf):
    part, whole = F.col("total_rt"), F.col("total")
    return shares(spark, sf).select(
        "journey_no",
        numbers.round_scaled(numbers.ratio(part, whole), 2).alias("rate"),
        numbers.percent(part, whole, 1).alias("percent_1"),
        numbers.percent(part, whole, 2).alias("percent_2"),
        numbers.percent(part, whole, 0).alias("percent_0"),
        numbers.ratio(whole, whole - part).alias("per_missing"),
    )


@query("C25 T3", """
  SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / (l_quantity + l_linenumber), 2) AS rate,
    count(*) AS total FROM lineitem GROUP BY ALL""", prelude=False)
def rounded_ratios(spark, sf):
    ratio = numbers.ratio(F.col("l_quantity"), F.col("l_quantity") + F.col("l_linenumber"))
    return (
        st.table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber", "l_partkey", numbers.round_scaled(ratio, 2).alias("rate"))
        .agg(F.count("*").alias("total"))
    )


@query("C26", """
  SELECT coalesce(operator, '-') AS operator, line_short, coalesce(max(CASE WHEN NOT ever_reported THEN journey_no END), '-') AS last_missing,
    count(*)::text AS total FROM journeys GROUP BY operator, line_short""")
def displayed_table(spark, sf):
    table = st.journeys(spark, sf).groupBy("operator", "line_short").agg(
        F.max(F.when(~F.col("ever_reported"), F.col("journey_no"))).alias("last_missing"),
        F.count("*").alias("total"),
    )
    return text.display_text(table)
