"""Uniform shuffle into shards of exact sizes, in DataFrame functions only.

Hypergeometric communication matrix: how many rows each partition sends to each shard is
drawn first, with the exact law of a uniform shuffle of all rows. Then every partition
permutes its rows and cuts them by its counts, the rows move once, and every shard
permutes again. The matrix is drawn by halving: the partitions are split in two halves,
the number of rows that the left half sends to each shard is hypergeometric, and the
halves are drawn on independently, all of one level in parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.rows import new_folder, packed, unpacked, written

BUCKET_ROWS = 20_000  # rows of a shard that one task permutes, about


def _log_factorial(x: Column) -> Column:
    """ln x!, by Stirling's series of (x + 8)! divided by the eight factors above x."""
    y = x + 8.0
    series = (y + 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi))
    series += 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    for i in range(1, 9):
        series -= F.log(x + float(i))
    return series


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def _uniform(*key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone, so a repeated task draws it again."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def hypergeometric(total: Column, good: Column, drawn: Column, uniform: Column) -> Column:
    """Good ones among ``drawn`` of ``total`` of which ``good`` are good, by inversion.

    Values are summed up from the mode outwards, right and left in turn, until their
    probability exceeds ``uniform``. Beyond 12 standard deviations nothing is left that a
    double could hold.
    """
    given = F.struct(
        total.cast("double").alias("total"), good.cast("double").alias("good"),
        (total - good).cast("double").alias("bad"), drawn.cast("double").alias("drawn"),
        uniform.alias("uniform"),
    )
    return _let(given, _ranged)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ranged(g: Column) -> Column:
    low = F.greatest(F.lit(0.0), g["drawn"] - g["bad"])
    high = F.least(g["good"], g["drawn"])
    middle = F.floor((g["drawn"] + 1) * (g["good"] + 1) / (g["total"] + 2)).cast("double")
    ends = F.struct(
        low.alias("low"), high.alias("high"), F.least(F.greatest(middle, low), high).alias("mode")
    )
    return _let(ends, lambda e: _weighed(g, e))


def _weighed(g: Column, e: Column) -> Column:
    at_mode = F.exp(
        _log_choose(g["good"], e["mode"])
        + _log_choose(g["bad"], g["drawn"] - e["mode"])
        - _log_choose(g["total"], g["drawn"])
    )
    return F.when(e["low"] >= e["high"], e["low"].cast("long")).otherwise(
        _let(at_mode, lambda p: _walked(g, e, p))
    )


def _walked(g: Column, e: Column, at_mode: Column) -> Column:
    total, good, bad, drawn, uniform = (g[n] for n in ("total", "good", "bad", "drawn", "uniform"))
    low, high, mode = e["low"], e["high"], e["mode"]
    variance = drawn * good * bad * (total - drawn) / F.greatest(total * total * (total - 1), F.lit(1.0))
    reach = F.least((12 * F.sqrt(variance) + 20).cast("int"), (high - low).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        up = s["right"] + 1
        p_up = F.when(
            up <= high,
            s["p_right"] * (good - up + 1) * (drawn - up + 1) / (up * (bad - drawn + up)),
        ).otherwise(0.0)
        down = s["left"] - 1
        p_down = F.when(
            down >= low,
            s["p_left"] * (down + 1) * (bad - drawn + down + 1) / ((good - down) * (drawn - down)),
        ).otherwise(0.0)
        after_up = s["sum"] + p_up
        found = (
            F.when(s["found"].isNotNull(), s["found"])
            .when((uniform < after_up) & (p_up > 0), up)
            .when((uniform < after_up + p_down) & (p_down > 0), down)
        )
        return F.struct(
            (after_up + p_down).alias("sum"), up.alias("right"), p_up.alias("p_right"),
            down.alias("left"), p_down.alias("p_left"), found.alias("found"),
        )

    begin = F.struct(
        at_mode.alias("sum"), mode.alias("right"), at_mode.alias("p_right"),
        mode.alias("left"), at_mode.alias("p_left"),
        F.when(uniform < at_mode, mode).alias("found"),
    )
    end = F.aggregate(F.sequence(F.lit(1), F.greatest(reach, F.lit(1))), begin, step)
    return F.coalesce(end["found"], mode).cast("long")


def _left_share(shards: Column, left: Column, key: Column) -> Column:
    """Rows that the left half sends to each shard, one shard after the other."""
    total = F.aggregate(shards, F.lit(0).cast("long"), lambda a, b: a + b)

    def step(s: Column, i: Column) -> Column:
        m = F.element_at(shards, i)
        k = hypergeometric(s["total"], m, s["left"], _uniform(key, i))
        return F.struct(
            (s["total"] - m).alias("total"), (s["left"] - k).alias("left"),
            F.concat(s["out"], F.array(k)).alias("out"),
        )

    begin = F.struct(
        total.alias("total"), left.alias("left"), F.array().cast("array<bigint>").alias("out")
    )
    return F.aggregate(F.sequence(F.lit(1), F.size(shards)), begin, step)["out"]


def communication_matrix(counts: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(part, to): rows that each partition sends to shards 0, 1, ...

    ``counts``: (part, n), parts from 0 without gaps. Shard sizes differ by one at most.
    One row holds the counts of all partitions: as many numbers as there are partitions.
    """
    every = counts.agg(F.array_sort(F.collect_list(F.struct("part", "n")))["n"].alias("ns"))
    total = F.aggregate("ns", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.floor(total / n_shards) + F.when(s < total % n_shards, 1).otherwise(0),
    )
    nodes = every.select(F.lit(0).alias("first"), "ns", sizes.alias("to"))
    depth = max(1, math.ceil(math.log2(max(2, counts.count()))))
    for level in range(depth):
        half = F.ceil(F.size("ns") / 2).cast("int")
        left_ns = F.slice("ns", 1, half)
        left = F.aggregate(left_ns, F.lit(0).cast("long"), lambda a, b: a + b)
        key = F.hash(F.lit(seed), F.lit(level), F.col("first"))
        drawn = nodes.withColumn("half", half).withColumn("mine", _left_share(F.col("to"), left, key))
        children = F.array(
            F.struct(F.col("first"), F.slice("ns", 1, F.col("half")).alias("ns"), F.col("mine").alias("to")),
            F.struct(
                (F.col("first") + F.col("half")).alias("first"),
                F.slice("ns", F.col("half") + 1, F.greatest(F.size("ns") - F.col("half"), F.lit(0))).alias("ns"),
                F.zip_with("to", "mine", lambda a, b: a - b).alias("to"),
            ),
        )
        nodes = drawn.select(F.explode(children).alias("c")).select("c.*").filter(F.size("ns") > 0)
    return nodes.select(F.col("first").alias("part"), "to")


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """Rows of ``df`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot``, gapless from 0.

    Every order of all rows is equally likely; shards differ by one row at most. Nothing
    about a row decides its place, so equal texts, hot keys, nulls and long rows need no
    care. An empty table gives no rows. Columns with the new names are replaced. Rows are
    written once below the shared folder, which fixes partitions and draws for reruns.
    """
    folder = new_folder(df, "sharding")
    local = (
        packed(df)
        .withColumns({"part": F.spark_partition_id(), "first_key": F.rand(seed)})
        .sortWithinPartitions("first_key")
        .withColumn("rank", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("first_key")
    )
    permuted = written(local, folder, "permuted")
    found = permuted.groupBy("part").agg(F.count("*").alias("n"))
    # partitions may be empty: numbered anew, without gaps
    numbered = written(
        found.withColumn("no", F.row_number().over(Window.orderBy("part")) - 1), folder, "counts"
    )
    counts = numbered.select(F.col("no").alias("part"), "n")
    matrix = communication_matrix(counts, n_shards, seed)
    bounds = numbered.join(matrix.withColumnRenamed("part", "no"), "no").select(
        "part",
        # where each shard's rows begin in the permuted partition
        F.aggregate(
            "to",
            F.array(F.lit(0).cast("long")),
            lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)),
        ).alias("cuts"),
    )
    bounds = written(bounds, folder, "bounds")
    shard = F.size(F.filter("cuts", lambda c: c <= F.col("rank"))) - 1

    total = numbered.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / n_shards / BUCKET_ROWS))
    draw = F.xxhash64(F.lit(seed), F.lit("second"), "part", "rank")
    placed = permuted.join(bounds, "part").select(
        "row", shard.alias("shard"), draw.alias("draw"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), "part", "rank"), F.lit(buckets)).alias("bucket"),
    )
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("begin")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("draw")
    slotted = placed.withColumn("place", F.row_number().over(inside)).join(
        begins, ["shard", "bucket"]
    )
    slot = (F.col("begin") + F.col("place") - 1).alias("slot")
    return unpacked(slotted.select("row", "shard", slot), "shard", "slot")
