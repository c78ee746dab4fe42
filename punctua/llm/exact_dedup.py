"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only rows that share their length and the hash of their beginning with another row have
their whole content hashed. Whether a row may be such a one is read from a bitmap, sized by the
number of such groups, inside the scan, so no text is shuffled to find out; a wrong yes costs
one hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.bitmap import with_maybe
from punctua.llm.rows import column, new_folder, unpacked, written

PREFIX = 256  # characters of the first hash
BITS, MOST_BITS = 1 << 20, 1 << 26  # of the bitmap: 2^20 longs at most, whatever the size of the table


def exact_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``df`` (all columns or those of ``carry``) with ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when all characters are; null counts as empty. Of equal texts the row
    with the largest id stays (a null id is the smallest); of rows equal in id and text one
    stays, so every group keeps exactly one row. ``keep_id`` is the id of the row that
    stays. Texts of any length are hashed whole; an empty table stays empty. The carried columns
    of rows that may have a twin are written once; all others stay where they are and are read
    again with the result. Columns with the new names are replaced.
    """
    folder = new_folder(df, "exact-dedup")
    body = F.coalesce(column(text), F.lit(""))
    carried = df.columns if carry is None else carry
    rows = df.select(
        F.struct(*(column(c) for c in carried)).alias("row"),
        column(id).alias("id"), body.alias("body"),
        F.octet_length(body).alias("length"),
        F.xxhash64(F.substring(body, 1, PREFIX)).alias("prefix"),
    )
    # One row per length and prefix leaves each task, so copies cost nothing here.
    by_prefix = rows.groupBy("length", "prefix").agg(F.count("*").alias("n"))
    shared = by_prefix.groupBy("length").agg(F.sum("n").alias("all")).filter("all > 1")
    groups = by_prefix.filter("n > 1").join(shared, "length", "left_semi")
    groups = written(groups.select("length", "prefix"), folder, "groups")
    code = F.xxhash64("length", "prefix")
    judged = with_maybe(rows, code, groups, code, BITS, MOST_BITS)
    hashed = judged.filter("maybe").select("row", "id", F.unhex(F.sha2("body", 256)).alias("full"))
    hashed = hashed.withColumn("tag", F.monotonically_increasing_id())
    # Written so that the tags, which tell equal rows apart, stay what they are.
    stored = written(hashed, folder, "hashed")
    first = F.struct(F.col("id"), (-F.col("tag")).alias("minus_tag"))
    classes = stored.groupBy("full").agg(F.max(first).alias("stays"), F.count("*").alias("size"))
    # Written, so that both sides of the join are plain tables: Spark can then split the
    # rows of a very large group, which it does not where one side is still an aggregate.
    classes = written(classes, folder, "classes")
    grouped = stored.join(classes, "full").select(
        "row", F.col("stays.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("tag") == -F.col("stays.minus_tag")).alias("kept"),
    )
    alone = judged.filter("NOT maybe").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return unpacked(grouped.unionByName(alone), "keep_id", "group_size", "kept")
