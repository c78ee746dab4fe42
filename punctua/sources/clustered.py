"""Day tables clustered by journey, so that stops, reports and extras of a journey lie in one bucket.

Next stops, reports beside stops and extras each shuffle their tables by journey. Clustered once,
when a delivery comes, the tables are read bucket by bucket and these operators need no shuffle
below their window or join (they use the column ``journey_key`` where both sides have it).

    <root>/by_journey/<table>_<buckets>/version=…/delivery_day=…/operating_day=…/*.parquet

The layout is derived: it has manifests of its own (see ``deliveries``), each line naming the folder
of the delivery it was made from, and a read is refused until it has caught up with the deliveries.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.operators.segments import JOURNEY_KEY, numbered
from punctua.schemas import TABLES
from punctua.session import shuffles_removed
from punctua.sources import deliveries
from punctua.sources.deliveries import DELIVERY, VERSION, Publication

SIDE = "by_journey"
ORDER = {"stop_events": ("line_id", "journey_no", "idx")}
# Lets a join on more columns than the clustered one do without a shuffle.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


class NotClustered(ValueError):
    """Deliveries have come that are not clustered yet."""


def with_journey_key(df: DataFrame) -> DataFrame:
    """Adds a hash of day and journey number, equal in every table.

    Rows without a number, NULL or '', belong to no known journey; a hash of all their columns spreads them.
    """
    known = F.xxhash64("operating_day", "journey_no")
    return df.withColumn(JOURNEY_KEY, F.when(numbered(), known).otherwise(F.xxhash64(*df.columns)))


def _present(spark: SparkSession, root: str, table: str) -> dict[str | None, str]:
    found = deliveries.current(deliveries.publications(spark, root))
    return {day: p.tables[table] for (day, name), p in found.items() if name == table}


def _made_from(spark: SparkSession, side: str, table: str) -> dict[str | None, tuple[str, str]]:
    """Of each clustered delivery its folder and the folder it was made from."""
    found = deliveries.current(deliveries.publications(spark, side))
    return {day: (p.tables[table], p.arrival or "") for (day, name), p in found.items() if name == table}


def _declared(spark: SparkSession, side: str, table: str, buckets: int) -> str:
    """The layout as a table of this session; it has no data of its own, the files name their buckets."""
    path = f"{side}/{table}_{buckets}"
    name = f"clustered_{hashlib.md5(path.encode()).hexdigest()}"
    location = path.replace("'", "\\'")
    order = ", ".join(ORDER.get(table, ("line_id", "journey_no")))
    columns = f"{TABLES[table]}, {JOURNEY_KEY} bigint, {VERSION} string, {DELIVERY} date"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" PARTITIONED BY ({VERSION}, {DELIVERY}, operating_day)"
        f" CLUSTERED BY ({JOURNEY_KEY}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def cluster_days(spark: SparkSession, root: str, table: str, buckets: int) -> list[str | None]:
    """Cluster the deliveries of a table that came since the last time; returns their days.

    ``buckets`` should leave a day's bucket at some 100 MB; tables to be joined need the same number.
    Rows of a bucket and day are brought together first, so each is one file, or several if it is
    heavy. What replaced deliveries left behind goes with ``deliveries.expire(<root>/by_journey)``.
    """
    root = root.rstrip("/")
    side, stored = f"{root}/{SIDE}", f"{table}_{buckets}"
    made = {day: source for day, (_, source) in _made_from(spark, side, stored).items()}
    new = {day: path for day, path in _present(spark, root, table).items() if made.get(day) != path}
    if not new:
        return []
    name, version = _declared(spark, side, table, buckets), deliveries.new_version()
    rows = deliveries.read(spark, f"{TABLES[table]}, {DELIVERY} date", root, table, sorted(new.values()))
    bucket = F.pmod(F.hash(JOURNEY_KEY), F.lit(buckets))
    keyed = with_journey_key(rows).withColumn("_bucket", bucket)
    # the version's name, long as it is, is added behind the shuffle
    columns = spark.table(name).columns
    near = keyed.hint("rebalance", "operating_day", "_bucket").withColumn(VERSION, F.lit(version))
    with shuffles_removed(spark):
        near.select(*columns).write.mode("append").insertInto(name)
    lines = [
        Publication(day, {stored: f"{stored}/{VERSION}={version}/{path.rpartition('/')[2]}"}, source="clustered", arrival=path)
        for day, path in new.items()
    ]
    deliveries.publish(spark, side, lines)
    return sorted(new, key=str)


def read_clustered(spark: SparkSession, root: str, table: str, buckets: int) -> DataFrame:
    """All present deliveries of a table, with ``journey_key``; day predicates prune its folders.

    Lets joins of the session use a clustering by fewer columns than they join on, unless the
    session's own configuration says otherwise.
    """
    root = root.rstrip("/")
    side, stored = f"{root}/{SIDE}", f"{table}_{buckets}"
    made, present = _made_from(spark, side, stored), _present(spark, root, table)
    behind = [day for day, path in present.items() if made.get(day, ("", ""))[1] != path]
    if behind:
        raise NotClustered(f"{table} of {sorted(map(str, behind))} is not clustered into {buckets} buckets yet")
    if CO_PARTITION not in {key for key, _ in spark.sparkContext.getConf().getAll()}:
        spark.conf.set(CO_PARTITION, "false")
    name = _declared(spark, side, table, buckets)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    rows = spark.table(name)
    if not present:
        return rows.limit(0).drop(VERSION, DELIVERY)
    # a version may hold deliveries that were replaced since, so both are compared
    folders = [made[day][0].split("/")[-2:] for day in present]
    versions, days = ([part.partition("=")[2] for part in column] for column in zip(*folders))
    day = F.coalesce(F.col(DELIVERY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    current = F.concat_ws("/", VERSION, day).isin(["/".join(pair) for pair in zip(versions, days)])
    return rows.where(F.col(VERSION).isin(sorted(set(versions))) & current).drop(VERSION, DELIVERY)
