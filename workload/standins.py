"""The supplied tables in the roles of journeys, lines, stop events and reports.

Orders stand for journeys, line items for stop events and delay reports,
nations for lines. ``PRELUDE`` is the same mapping as SQL. Keys are chosen so
that journeys per day and days per journey grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"
# Days before AS_OF that reach back beyond the first order.
WHOLE_SPAN = 2500
# Days covered by the stop events.
STOP_DAYS = 2400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer, rank = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    day = F.to_date("o_orderdate")
    urgent = rank == "1-URGENT"
    minute = F.lpad((key % 60).cast("string"), 2, "0")
    return table(spark, sf_dir, "orders").select(
        day.alias("operating_day"),
        _text("J", customer).alias("journey_no"),
        _text("Ziel ", customer % 97).alias("destination"),
        (F.col("o_orderstatus") != "P").alias("has_realtime"),
        ((F.col("o_orderstatus") != "P") | (key % 2 == 0)).alias("ever_reported"),
        F.nullif(rank, F.lit("5-LOW")).alias("operator"),
        _text("de:NET:", customer % 25, ":", key % 3).alias("line_id"),
        _text("de:NET:", customer % 25).alias("line_id_short"),
        _text("L", customer % 25 % 9).alias("line_short"),
        urgent.alias("reported_cancelled"),
        (key % 20 == 3).alias("journey_cancelled"),
        F.when(urgent, _text(day, "T08:00:00+01:00")).otherwise("").alias("ts_reported_cancelled"),
        (urgent | (key % 20 == 3)).alias("cancelled_any"),
        F.when(key % 5 == 0, _text("net#", customer)).otherwise(_text("net#dev#c", customer % 13)).alias("device_id"),
        F.when(key % 5 == 0, F.lit("-")).otherwise(_text("c", customer % 13)).alias("client_id"),
        rank.alias("rt_type"),
        _text(day, "T06:", minute, ":00+01:00").alias("start_time"),
        _text("Ort", customer % 10, " Markt").alias("start_station"),
        _text("de:1:", customer % 10).alias("start_station_id"),
        _text(day, "T07:", minute, ":30+01:00").alias("end_time"),
        _text("Ort", customer % 7, " Bahnhof").alias("end_station"),
        _text("de:2:", customer % 7).alias("end_station_id"),
    )


def extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra journeys: the orders of the highest and the lowest priority."""
    return journeys(spark, sf_dir).where(F.col("rt_type").isin("1-URGENT", "5-LOW"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line master data under the column names of its database."""
    number = F.col("n_nationkey")
    tiers = F.array(*[F.lit(t) for t in ("1+", "1", "2", "3", "Stadt", "Nacht")])
    return table(spark, sf_dir, "nation").select(
        number.alias("nummer"),
        F.when(number == 24, None)
        .when(number == 23, F.lit("nahsh"))
        .otherwise(_text("Bündel ", number % 12))
        .alias("buendel"),
        F.get(tiers, number % 6).alias("ebene"),
        _text("de:NET:", number).alias("dlid"),
        (number + 100).alias("id"),
        (F.col("n_name") != "NATION_22").alias("aktiv"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from punctua.sources.master import active_lines

    return active_lines(raw_lines(spark, sf_dir))


# Stored columns that wider ones are made of.
STORED = (
    "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def _stop_columns() -> list[Column]:
    """Columns of stop reports, of those of line items."""
    trip = F.floor(F.col("l_orderkey") / STOP_DAYS).cast("bigint")
    day = F.date_sub(F.lit(AS_OF).cast("date"), (F.col("l_orderkey") % STOP_DAYS).cast("int"))
    stop, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    place, amount = F.col("l_suppkey"), F.col("l_quantity").cast("int")
    minutes = ((trip % 24) * 60 + 50 + stop * 3).cast("int")
    dwell = F.when(flag == "A", 3).when(flag == "N", 1).otherwise(5)
    start = day.cast("timestamp_ntz")
    name = F.when((place % 7 == 0) & (flag == "R"), _text("Endstelle", place)).otherwise(
        _text("Ort", place % 10, " Halt ", place)
    )
    return [
        day.alias("operating_day"),
        flag.alias("operator"),
        _text("net#dev#c", trip % 13).alias("device_id"),
        _text("L", trip % 25).alias("line_short"),
        _text("de:NET:", trip % 25, ":1").alias("line_id"),
        _text("de:NET:", trip % 25).alias("line_id_short"),
        _text("T", trip).alias("journey_no"),
        stop.alias("idx"),
        ((status == "O") | (flag != "R")).alias("has_rt"),
        F.timestamp_add("MINUTE", minutes, start).alias("sched_dep"),
        F.timestamp_add("MINUTE", minutes - dwell, start).alias("sched_arr"),
        F.when(F.col("l_discount") == 0, None)
        .otherwise(amount % 4 - 1 + F.when(F.col("l_tax") == 0, 35).otherwise(0))
        .cast("double")
        .alias("dep_delay"),
        F.when(F.col("l_tax") == 0.08, None).otherwise(amount % 5 - 1).cast("double").alias("arr_delay"),
        place.cast("string").alias("station_no"),
        name.alias("station_name"),
        ((place % 1000 + 52000) / F.lit(1000)).alias("lat"),
        ((place * 37 % 3000 + 7500) / F.lit(1000)).alias("lon"),
        ((flag == "R") & (status == "F")).alias("cancelled"),
        (F.col("l_tax") == 0).alias("additional"),
        F.when(flag == "R", _text(day, "T08:00:00+01:00")).otherwise("").alias("ts_reported_cancelled"),
        (flag == "R").alias("reported_cancelled"),
        F.col("l_partkey").alias("report_no"),
        F.col("l_extendedprice").alias("report_size"),
    ]


def stop_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as stop events; repeated items of an order are repeated reports."""
    return table(spark, sf_dir, "lineitem").select(*_stop_columns())


def stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop events with one row per journey and stop index.

    Items are sorted and shuffled as they are stored, beside journey and order; the wider columns are
    made of those that stay.
    """
    from punctua.operators.segments import JOURNEY, one_row_per_stop

    tie = ("report_no", "report_size", "station_no", "operator", "additional")
    items, columns = table(spark, sf_dir, "lineitem"), _stop_columns()
    named = dict(zip(items.select(*columns).columns, columns, strict=True))
    keyed = items.select(*STORED, *(named[c] for c in (*JOURNEY, "idx", *tie)))
    made = [F.col(c) if c in keyed.columns else column for c, column in named.items()]
    return one_row_per_stop(keyed, tie).select(*made).drop("report_no", "report_size")


def delay_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one delay report, repeats included."""
    from punctua.functions.days import local_text

    instant = F.timestamp_seconds(
        F.unix_date(F.to_date("l_shipdate")) * F.lit(86400) + F.col("l_partkey") * 11 % 86400
    )
    trip = F.floor(F.col("l_orderkey") / STOP_DAYS).cast("bigint")
    day = F.date_sub(F.lit(AS_OF).cast("date"), (F.col("l_orderkey") % STOP_DAYS).cast("int"))
    flag, place, amount = F.col("l_returnflag"), F.col("l_suppkey"), F.col("l_quantity").cast("int")
    name = F.when((place % 7 == 0) & (flag == "R"), _text("Endstelle", place)).otherwise(
        _text("Ort", place % 10, " Halt ", place)
    )
    return table(spark, sf_dir, "lineitem").select(
        day.alias("operating_day"),
        flag.alias("operator"),
        _text("L", trip % 25).alias("line_short"),
        _text("de:NET:", trip % 25, ":1").alias("line_id"),
        _text("T", trip).alias("journey_no"),
        F.when(F.col("l_tax") == 0.01, "")
        .otherwise(_text(F.replace(day.cast("string"), F.lit("-"), F.lit("")), F.lpad((amount % 24).cast("string"), 2, "0"), "3000"))
        .alias("sched_dep"),
        place.cast("int").alias("station_no"),
        F.when(F.col("l_tax") == 0.08, None).otherwise(amount % 5 - 1).cast("double").alias("delay_arrival"),
        F.when(F.col("l_discount") == 0, None).otherwise(amount % 4 - 1).cast("double").alias("delay_departure"),
        ((flag == "R") & (F.col("l_linestatus") == "F")).alias("stop_cancelled"),
        local_text(instant).alias("reported_at"),
        name.alias("station_name"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct stations of the stop reports; some numbers have two names."""
    return stop_reports(spark, sf_dir).select("station_no", "lat", "lon", "station_name").distinct()


PRELUDE = """
WITH journeys AS (
  SELECT o_orderdate::date AS operating_day, 'J' || o_custkey AS journey_no,
    'Ziel ' || (o_custkey % 97) AS destination,
    o_orderstatus <> 'P' AS has_realtime,
    (o_orderstatus <> 'P' OR o_orderkey % 2 = 0) AS ever_reported,
    nullif(o_orderpriority, '5-LOW') AS operator,
    'de:NET:' || (o_custkey % 25) || ':' || (o_orderkey % 3) AS line_id,
    'de:NET:' || (o_custkey % 25) AS line_id_short,
    'L' || (o_custkey % 25 % 9) AS line_short,
    o_orderpriority = '1-URGENT' AS reported_cancelled,
    o_orderkey % 20 = 3 AS journey_cancelled,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate::date || 'T08:00:00+01:00' ELSE '' END AS ts_reported_cancelled,
    (o_orderpriority = '1-URGENT' OR o_orderkey % 20 = 3) AS cancelled_any,
    CASE WHEN o_orderkey % 5 = 0 THEN 'net#' || o_custkey ELSE 'net#dev#c' || (o_custkey % 13) END AS device_id,
    CASE WHEN o_orderkey % 5 = 0 THEN '-' ELSE 'c' || (o_custkey % 13) END AS client_id,
    o_orderpriority AS rt_type,
    o_orderdate::date || 'T06:' || lpad((o_orderkey % 60)::text, 2, '0') || ':00+01:00' AS start_time,
    'Ort' || (o_custkey % 10) || ' Markt' AS start_station,
    'de:1:' || (o_custkey % 10) AS start_station_id,
    o_orderdate::date || 'T07:' || lpad((o_orderkey % 60)::text, 2, '0') || ':30+01:00' AS end_time,
    'Ort' || (o_custkey % 7) || ' Bahnhof' AS end_station,
    'de:2:' || (o_custkey % 7) AS end_station_id
  FROM orders),
extras AS (SELECT * FROM journeys WHERE rt_type IN ('1-URGENT', '5-LOW')),
raw_lines AS (
  SELECT n_nationkey AS nummer,
    CASE n_nationkey WHEN 24 THEN NULL WHEN 23 THEN 'nahsh' ELSE 'Bündel ' || (n_nationkey % 12) END AS buendel,
    ['1+', '1', '2', '3', 'Stadt', 'Nacht'][n_nationkey % 6 + 1] AS ebene,
    'de:NET:' || n_nationkey AS dlid, n_nationkey + 100 AS id, n_name <> 'NATION_22' AS aktiv
  FROM nation),
lines AS (
  SELECT nummer::text AS line, buendel AS bundle, ebene AS tier, dlid AS line_id_short, id::text AS id
  FROM raw_lines WHERE buendel IS NOT NULL AND aktiv IS TRUE),
items AS (
  SELECT *, l_orderkey // 2400 AS trip, DATE '2001-08-01' - (l_orderkey % 2400)::int AS operating_day,
    CASE WHEN l_suppkey % 7 = 0 AND l_returnflag = 'R' THEN 'Endstelle' || l_suppkey
      ELSE 'Ort' || (l_suppkey % 10) || ' Halt ' || l_suppkey END AS station_name
  FROM lineitem),
stop_reports AS (
  SELECT operating_day, l_returnflag AS operator, 'net#dev#c' || (trip % 13) AS device_id,
    'L' || (trip % 25) AS line_short, 'de:NET:' || (trip % 25) || ':1' AS line_id,
    'de:NET:' || (trip % 25) AS line_id_short, 'T' || trip AS journey_no, l_linenumber AS idx,
    (l_linestatus = 'O' OR l_returnflag <> 'R') AS has_rt,
    operating_day::timestamp + to_minutes((trip % 24) * 60 + 50 + l_linenumber * 3) AS sched_dep,
    operating_day::timestamp + to_minutes((trip % 24) * 60 + 50 + l_linenumber * 3
      - CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 1 ELSE 5 END) AS sched_arr,
    (CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity::int % 4 - 1
      + CASE WHEN l_tax = 0 THEN 35 ELSE 0 END END)::double AS dep_delay,
    (CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity::int % 5 - 1 END)::double AS arr_delay,
    l_suppkey::text AS station_no, station_name,
    (l_suppkey % 1000 + 52000) / 1000 AS lat, (l_suppkey * 37 % 3000 + 7500) / 1000 AS lon,
    l_returnflag = 'R' AND l_linestatus = 'F' AS cancelled, l_tax = 0 AS additional,
    CASE WHEN l_returnflag = 'R' THEN operating_day || 'T08:00:00+01:00' ELSE '' END AS ts_reported_cancelled,
    l_returnflag = 'R' AS reported_cancelled, l_partkey AS report_no, l_extendedprice AS report_size
  FROM items),
stop_events AS (
  SELECT * EXCLUDE (report_no, report_size) FROM stop_reports
  QUALIFY row_number() OVER (PARTITION BY operating_day, line_id, journey_no, idx
    ORDER BY report_no, report_size, station_no, operator, additional) = 1),
delay_reports AS (
  SELECT operating_day, l_returnflag AS operator, 'L' || (trip % 25) AS line_short,
    'de:NET:' || (trip % 25) || ':1' AS line_id, 'T' || trip AS journey_no,
    CASE WHEN l_tax = 0.01 THEN '' ELSE strftime(operating_day, '%Y%m%d')
      || lpad((l_quantity::int % 24)::text, 2, '0') || '3000' END AS sched_dep,
    l_suppkey::int AS station_no,
    (CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity::int % 5 - 1 END)::double AS delay_arrival,
    (CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity::int % 4 - 1 END)::double AS delay_departure,
    l_returnflag = 'R' AND l_linestatus = 'F' AS stop_cancelled,
    strftime(timezone('Europe/Berlin', timezone('UTC', l_shipdate::date::timestamp
      + to_seconds(l_partkey * 11 % 86400))), '%Y-%m-%d %H:%M:%S') AS reported_at,
    station_name
  FROM items),
stations AS (SELECT DISTINCT station_no, lat, lon, station_name FROM stop_reports),
known_journeys AS (
  SELECT j.*, l.bundle, l.tier FROM journeys j JOIN lines l USING (line_id_short)),
reports AS (
  SELECT b.bundle AS report_bundle, l.tier, l.line_id_short, l.bundle
  FROM (SELECT DISTINCT bundle FROM lines WHERE bundle NOT IN ('nahsh')) b
  JOIN lines l ON contains(l.bundle, b.bundle)),
report_journeys AS (
  SELECT r.report_bundle, r.tier, j.* FROM journeys j JOIN reports r USING (line_id_short))
"""
