"""Bitmaps of fixed size that tell which hashed keys may be in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place(code: Column, bits: int) -> tuple[Column, Column]:
    """Index of the long and of the bit in it that stand for a 64-bit code."""
    bit = F.pmod(code, F.lit(bits))
    return (bit / 64).cast("int"), F.pmod(bit, F.lit(64)).cast("int")


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def fitting_bits(count: int, least: int, most: int) -> int:
    """A power of two: 16 bits a key, so that few of the others seem known, within the bounds."""
    return min(max(least, 1 << (16 * max(count, 1) - 1).bit_length()), most)


def with_maybe(df: DataFrame, code: Column, keys: DataFrame, key: Column, least: int, most: int) -> DataFrame:
    """``df`` with ``maybe``: false where ``code`` is surely not among the ``key`` of ``keys``.

    The bits are broadcast, at most ``most`` / 64 longs of them; ``keys`` is read twice.
    """
    bits = fitting_bits(keys.count(), least, most)
    word, bit = place(key, bits)
    words = keys.groupBy(word.alias("word")).agg(F.bit_or(_one(bit)).alias("bits"))
    word, bit = place(code, bits)
    looked_up = df.withColumns({"word": word, "bit": bit}).join(F.broadcast(words), "word", "left")
    known = F.coalesce(F.getbit("bits", "bit") == 1, F.lit(False))
    return looked_up.withColumn("maybe", known).drop("word", "bit", "bits")


def bitmap(codes: DataFrame, code: Column, bits: int) -> list[int]:
    """The bits of all codes as longs; at most ``bits`` / 64 rows come to the driver."""
    word, bit = place(code, bits)
    words = codes.groupBy(word.alias("word")).agg(F.bit_or(_one(bit)).alias("bits")).collect()
    out = [0] * (bits // 64)
    for row in words:
        out[row["word"]] = row["bits"]
    return out
