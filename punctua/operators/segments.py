"""Stop-to-stop segments of a journey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.functions import geo

JOURNEY = ("operating_day", "line_id", "journey_no")
# Hash of day and journey number; tables clustered by it bring it along (``sources.clustered``).
JOURNEY_KEY = "journey_key"
CARRIED = (
    "idx", "station_no", "station_name", "sched_dep", "sched_arr",
    "dep_delay", "arr_delay", "lat", "lon",
)


def numbered() -> Column:
    """Rows that name their journey; ingest writes '' for a missing number."""
    return F.coalesce(F.col("journey_no") != "", F.lit(False))


def clustering(*sides: DataFrame) -> tuple[str, ...]:
    """The column that all sides are clustered by, if they are: to be put before the keys."""
    return (JOURNEY_KEY,) if all(JOURNEY_KEY in side.columns for side in sides) else ()


def one_row_per_stop(stop_events: DataFrame, tie: tuple[str, ...]) -> DataFrame:
    """One row per journey and index: the first in the order of the ``tie`` columns.

    Rows without a journey number may belong to many journeys and all stay.
    Spark limits each scan task to one row per key before the shuffle, so a
    key with very many copies does not travel; unused columns are pruned.
    """
    apart = F.when(numbered(), F.lit(0)).otherwise(F.monotonically_increasing_id())
    copies = Window.partitionBy(*JOURNEY, "idx", "apart").orderBy(*tie)
    ranked = stop_events.withColumn("apart", apart).withColumn("copy", F.row_number().over(copies))
    return ranked.where("copy = 1").drop("copy", "apart")


def repeated_stops(stop_events: DataFrame) -> DataFrame:
    """Journeys and indices that occur more than once, with the number of rows.

    A stop can follow only one of them, so clear these (``one_row_per_stop``)
    before linking stops.
    """
    known = stop_events.where(numbered() & F.col("idx").isNotNull())
    return known.groupBy(*JOURNEY, "idx").agg(F.count("*").alias("rows")).where("rows > 1")


def next_stops(stops: DataFrame, carried: tuple[str, ...] = CARRIED) -> DataFrame:
    """Each stop with the ``carried`` columns of the next stop, as ``*_next``.

    The last stop of a journey drops out, as do stops without a journey
    number or index, which no journey can be made of. Of repeated rows of a
    journey and index (see ``repeated_stops``) only the last in the order of
    the carried columns is linked onwards, and none to another of them.
    Stops clustered by journey are not shuffled.
    """
    ahead = F.struct(*[F.col(c).alias(c) for c in carried])
    usable = stops.where(numbered() & F.col("idx").isNotNull())
    along = Window.partitionBy(*clustering(stops), *JOURNEY).orderBy("idx", *[c for c in carried if c != "idx"])
    pair = F.struct(F.lead(ahead).over(along).alias("ahead"), F.lead("idx").over(along).alias("idx"))
    return (
        usable.withColumn("then", pair)
        .where(F.col("then.idx") > F.col("idx"))
        .select(*stops.columns, *[F.col(f"then.ahead.{c}").alias(f"{c}_next") for c in carried])
    )


def with_metres(stops: DataFrame) -> DataFrame:
    """Projected ``east`` and ``north`` of every stop, once per stop and not per segment."""
    xi, eta = geo.transverse_sphere(F.col("lat"), F.col("lon"))
    sphere = stops.withColumn("xi", xi).withColumn("eta", eta)
    east, north = geo.krueger_metres(F.col("xi"), F.col("eta"))
    return sphere.withColumn("east", east).withColumn("north", north).drop("xi", "eta")


def segments(stops: DataFrame) -> DataFrame:
    """Length, scheduled time, speed and change of delay from each stop to the next."""
    linked = next_stops(with_metres(stops), (*CARRIED, "east", "north"))
    metres = geo.straight_line_m(*[F.col(c) for c in ("east", "north", "east_next", "north_next")])
    return (
        linked.withColumn("metres", metres)
        .withColumn("seconds", geo.scheduled_seconds(F.col("sched_dep"), F.col("sched_arr_next")))
        .withColumn("km_h", geo.plausible_speed(F.col("metres"), F.col("seconds")))
        .withColumn("delay_change", F.col("arr_delay_next") - F.col("arr_delay"))
        .drop("east", "north", "east_next", "north_next")
    )
