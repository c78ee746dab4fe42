"""URL rules by sorted sweeps over reversed-host keys, in DataFrame functions only.

Sort-merge range join: a host read backwards puts every host of ``example.net`` and its
subdomains between two keys, a path prefix likewise, so each rule is an interval and any
two intervals are nested or apart. A sweep over the sorted interval ends and points keeps
a stack of the open intervals: its height is a running sum, its element at height h is
the last interval that opened at height h.

The sweep is dealt over range partitions. What a partition inherits (height, open
intervals) is computed from one row per partition and height, never from its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.rows import column, new_folder, packed, unpacked, written

OPEN, POINT, CLOSE = 0, 1, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lowered), then the path; '' for both without one."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    # '?' or '#' right after the host leaves an empty path
    found = F.coalesce(at > 0, F.lit(False))
    lowered = F.translate(host, UPPER, LOWER)
    return F.when(found, lowered).otherwise(""), F.when(found, path).otherwise("")


def host_key(host: Column) -> Column:
    """Backwards and closed by a dot: a subdomain's key starts with its domain's."""
    return F.encode(F.concat(F.reverse(host), F.lit(".")), "UTF-8")


def sweep(points: DataFrame, intervals: DataFrame, every: bool) -> DataFrame:
    """Pairs of ``point`` and ``interval`` with the point's key inside the interval.

    ``points``: distinct rows (key binary, point). ``intervals``: distinct rows (key binary,
    interval); an interval holds all keys that begin with its own. ``every``: the whole
    stack of each point, else only its top, the longest.
    """
    start = intervals.select(
        "key", F.lit(OPEN).alias("kind"), F.lit(1).alias("step"), "interval",
        F.lit(None).cast(points.schema["point"].dataType).alias("point"),
    )
    # 0xFF occurs in no UTF-8 text, so this key follows all keys with the prefix
    end = start.select(
        F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(CLOSE).alias("kind"),
        F.lit(-1).alias("step"), "interval", "point",
    )
    at = points.select(
        "key", F.lit(POINT).alias("kind"), F.lit(0).alias("step"),
        F.lit(None).cast(intervals.schema["interval"].dataType).alias("interval"), "point",
    )
    order = ["key", "kind"]
    # Written once: the range bounds are sampled, and the steps below must see one dealing.
    dealt = start.unionByName(end).unionByName(at).repartitionByRange(*order)
    events = written(
        dealt.withColumn("part", F.spark_partition_id()), new_folder(points, "sweep"), "events"
    )

    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per partition: as few as the write had tasks
    heights = (
        events.groupBy("part")
        .agg(F.sum("step").alias("rise"))
        .withColumn(
            "base",
            F.coalesce(
                F.sum("rise").over(
                    Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
    )
    levelled = (
        events.withColumn("climb", F.sum("step").over(before))
        .join(heights.select("part", "base"), "part")
        .withColumn("height", (F.col("climb") + F.col("base")).cast("int"))
        .filter(F.col("kind") != CLOSE)
        .select("part", "key", "kind", "interval", "point", "height")
    )
    # A point asks for the heights of its stack; an opening answers for its own.
    asked = F.sequence(F.lit(1), "height") if every else F.array("height")
    levels = F.when(F.col("kind") == OPEN, F.array("height")).otherwise(asked)
    asking = levelled.filter(F.col("height") > 0).select(
        "part", "key", "kind", "interval", "point", F.explode(levels).alias("height")
    )
    inside = (
        Window.partitionBy("part", "height")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    answered = asking.withColumn("here", F.last("interval", ignorenulls=True).over(inside))
    # The last opening of each partition and height goes to the partitions after it. One row
    # per partition and height is left here, so a window over one height stays short.
    last = asking.filter(F.col("kind") == OPEN).groupBy("part", "height")
    handed = last.agg(F.max_by("interval", "key").alias("left"))
    missing = answered.filter((F.col("kind") == POINT) & F.col("here").isNull())
    needing = missing.select("part", "height").distinct()
    earlier = (
        Window.partitionBy("height").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        needing.join(handed, ["part", "height"], "full_outer")
        .withColumn("inherited", F.last("left", ignorenulls=True).over(earlier))
        .select("part", "height", "inherited")
    )
    return (
        answered.filter(F.col("kind") == POINT)
        .join(carried, ["part", "height"], "left")
        .select("point", F.coalesce("here", "inherited").alias("interval"))
    )


def judge_urls(
    df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Rows of ``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules``: (host, path, verdict). A rule fits its host and all subdomains where the
    path begins with the rule's. Of several the longest text ``host + path`` wins, of equal
    lengths the longer host. Without a rule ``rule`` is null and the verdict ``default``.

    A null or malformed url has host and path '' and meets only a rule for these. A rule
    with null host is void, one with null path fits every path; of repeated rules with
    different verdicts the last in alphabetical order counts. Urls of any length are compared
    whole; an empty table stays empty, without rules every url has the default. Repeated urls are judged once
    and each row gets the verdict. Columns of ``df`` with the new names are replaced.
    """
    host, path = host_and_path(column(url))
    rows = packed(df, host=host, path=path)
    known = (
        rules.filter(F.col("host").isNotNull())
        .select(
            F.translate("host", UPPER, LOWER).alias("fit"),
            F.coalesce("path", F.lit("")).alias("begin"), "verdict",
        )
        .groupBy("fit", "begin")
        .agg(F.max("verdict").alias("verdict"))
    )
    urls = rows.select("host", "path").distinct()

    hosts = urls.select(F.col("host").alias("point")).distinct()
    domains = known.select(F.col("fit").alias("interval")).distinct()
    nested = sweep(
        hosts.withColumn("key", host_key(F.col("point"))),
        domains.withColumn("key", host_key(F.col("interval"))),
        every=True,
    ).select(F.col("point").alias("host"), F.col("interval").alias("fit"))

    # No host has a '/', so keys of different domains never begin alike.
    scoped = urls.join(nested, "host").select(
        F.encode(F.concat("fit", F.lit("/"), "path"), "UTF-8").alias("key"),
        F.struct("host", "path", "fit").alias("point"),
    )
    prefixes = known.select(
        F.encode(F.concat("fit", F.lit("/"), "begin"), "UTF-8").alias("key"),
        F.struct("fit", "begin", "verdict").alias("interval"),
    )
    longest = F.struct(
        F.length(F.concat("interval.fit", "interval.begin")), F.length("interval.fit"), "interval"
    )
    judged = (
        sweep(scoped, prefixes, every=False)
        .groupBy("point.host", "point.path")
        .agg(F.max(longest)["interval"].alias("won"))
        .select(
            "host", "path", F.concat("won.fit", "won.begin").alias("rule"),
            F.col("won.verdict").alias("verdict"),
        )
    )
    # A plain table and not an aggregate: Spark can then split the rows of a much repeated url.
    judged = written(judged, new_folder(df, "url-filter"), "judged")
    result = rows.join(judged, ["host", "path"], "left")
    result = result.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    return unpacked(result, "host", "path", "rule", "verdict")
