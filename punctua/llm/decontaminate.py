"""Marks the words of documents that occur in benchmark items.

Prefix-filtered set join: an item is cut into windows, a window is the set of its word
runs (shingles). Shingles are ordered by rarity over all documents. A window can only
occur where its rarest shingle does, so only that prefix of each set is joined with the
documents. Bounds on position and length drop matches whose window would leave the
document; the rest is verified word by word over the item-sized window.

A bitmap of fixed size keeps document shingles that no item has out of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm import texts
from punctua.llm.bitmap import bitmap
from punctua.llm.rows import column, new_folder, packed, prepare_workers, unpacked, written

WINDOW = 10  # words
SHINGLE = 4  # words
BITS = 1 << 22  # of the bitmap, 512 KB whatever the number of items


def _item_windows(window: int, shingle: int):
    """Rows (item, window, offset, code, words): every shingle of every window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("item", "window", "words", "offset", "gram", "code")
        for batch in batches:
            out = {n: [] for n in names}
            bodies = [texts.lower_bytes(t) for t in batch.column("body").to_pylist()]
            item = batch.column("item").to_pylist()
            for first, block in texts.blocks(bodies):
                w = texts.words(block, texts.ALPHANUMERIC)
                begin = np.concatenate(([0], np.cumsum(w.per_doc)))
                grams = {k: dict(zip(*(x.tolist() for x in texts.runs(w, k)), strict=True))
                         for k in range(1, shingle + 1)}
                for d in range(len(block)):
                    a, b = int(begin[d]), int(begin[d + 1])
                    size = min(window, b - a)
                    width = min(shingle, size)
                    for s in range(a, b - size + 1) if size else ():
                        words = w.text(s, s + size).decode()
                        for at in range(size - width + 1):
                            row = (item[first + d], s - a, words, at,
                                   w.text(s + at, s + at + width).decode(), grams[width][s + at])
                            for n, v in zip(names, row, strict=True):
                                out[n].append(v)
            codes = pa.array(np.array(out.pop("code"), np.uint64).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], batch.schema.field("item").type),
                 pa.array(out["window"], pa.int32()), pa.array(out["words"], pa.string()),
                 pa.array(out["offset"], pa.int32()), pa.array(out["gram"], pa.string()), codes],
                names=list(names),
            )

    return cut


def _bits(codes: DataFrame) -> np.ndarray:
    words = np.array(bitmap(codes, F.col("code"), BITS), np.int64)
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def _hits(w: texts.Words, widths: list[int], bits: np.ndarray) -> Iterator[tuple]:
    """Width, first words and codes of the runs whose bit is set."""
    for width in widths:
        first, codes = texts.runs(w, width)
        found = bits[(codes & np.uint64(BITS - 1)).astype(np.int64)]
        yield width, first[found], codes[found]


def _counted(widths: list[int], known):
    """Rows (code, n): how often each possible item shingle occurs in a batch of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [texts.lower_bytes(t) for t in batch.column("body").to_pylist()]
            found = [np.zeros(0, np.uint64)]
            for _, block in texts.blocks(bodies):
                w = texts.words(block, texts.ALPHANUMERIC)
                found += [codes for _, _, codes in _hits(w, widths, known.value)]
            codes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"]
            )

    return count


SCANNED = "n_words bigint, hits array<struct<at:int,gram:string,before:string,after:string>>"


def _scanned(widths: list[int], reach: int, known):
    """Word count of each document and its possible prefix shingles with the words around."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("at", pa.int32()), ("gram", pa.string()),
                          ("before", pa.string()), ("after", pa.string())])
        for batch in batches:
            bodies = [texts.lower_bytes(t) for t in batch.column("body").to_pylist()]
            n_words, hits = [], []
            for _, block in texts.blocks(bodies):
                w = texts.words(block, texts.ALPHANUMERIC)
                begin = np.concatenate(([0], np.cumsum(w.per_doc))).tolist()
                mine: list[list] = [[] for _ in block]
                for width, first, _ in _hits(w, widths, known.value):
                    for p, d in zip(first.tolist(), w.doc[first].tolist(), strict=True):
                        a, b = begin[d], begin[d + 1]
                        mine[d].append({
                            "at": p - a,
                            "gram": w.text(p, p + width).decode(),
                            "before": w.text(max(a, p - reach), p).decode(),
                            "after": w.text(p + width, min(b, p + width + reach)).decode(),
                        })
                n_words += w.per_doc.tolist()
                hits += mine
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("print"),
                 pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(kind))],
                names=["id", "print", "n_words", "hits"],
            )

    return scan


def contamination(
    df: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row (id, print, n_words, n_hit, spans, items) for each row of ``df``.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z as
    a-z. A window is ``window`` consecutive words of an item, or the whole of a shorter
    one. ``spans`` are the word ranges [start, end) of all occurrences of windows, merged
    only where equal; ``n_hit`` counts the words inside any of them; ``items`` lists, as
    sorted strings, the ids of the items that have an occurring window.

    ``print`` is a hash of the text, which tells rows of a repeated or null id apart. Null
    and wordless texts and items have no words and no windows. Items with a null id mark
    words but are not listed. Repeated items count once. Empty tables give no hits.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    folder = new_folder(df, "decontaminate")
    item_type = items.schema[item_id].dataType.simpleString()
    cut = items.select(
        column(item_id).alias("item"), F.coalesce(column(item_text), F.lit("")).alias("body")
    ).mapInArrow(
        _item_windows(window, shingle),
        f"item {item_type}, window int, words string, offset int, gram string, code bigint",
    )
    cut = written(cut, folder, "windows")
    # the whole shingle width, and those of shorter items: at most ``shingle`` numbers
    width = F.size(F.split("gram", " "))
    widths = sorted(r[0] for r in cut.select(width).distinct().collect())

    body = F.coalesce(column(text), F.lit(""))
    source = df.select(column(id).alias("id"), F.xxhash64(body).alias("print"), body.alias("body"))
    all_bits = spark.sparkContext.broadcast(_bits(cut))
    counted = source.select("body").mapInArrow(_counted(widths, all_bits), "code bigint, n bigint")
    rarity = counted.groupBy("code").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)), "code", "offset", "gram"))
    prefixes = (
        cut.join(rarity, "code", "left")
        .groupBy("item", "words")
        .agg(rarest.alias("p"))
        .select("item", "words", "p.*")
    )
    prefixes = written(prefixes, folder, "prefixes")

    id_type = df.schema[id].dataType.simpleString()
    prefix_bits = spark.sparkContext.broadcast(_bits(prefixes))
    scanned = source.mapInArrow(
        _scanned(widths, max(window - 1, 0), prefix_bits), f"id {id_type}, print bigint, {SCANNED}"
    )
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), folder, "scanned")

    size = F.size(F.split("words", " "))
    start = F.col("at") - F.col("offset")
    # Words of the document at the place of the window, from the context of the shingle.
    before = F.slice(F.split("before", " "), -F.greatest("offset", F.lit(1)), F.col("offset"))
    rest = size - F.col("offset") - F.size(F.split("gram", " "))
    after = F.slice(F.split("after", " "), 1, rest)
    there = F.array_join(F.concat(before, F.array("gram"), after), " ")
    found = (
        scanned.filter(F.size("hits") > 0)
        .select("row", "n_words", F.explode("hits").alias("hit"))
        .select("row", "n_words", "hit.*")
        .join(prefixes, "gram")
        .filter((start >= 0) & (start + size <= F.col("n_words")) & (there == F.col("words")))
        .select("row", "item", start.alias("start"), (start + size).alias("end"))
    )
    found = written(found, folder, "found")
    listed = found.groupBy("row").agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    spans = found.select("row", "start", "end").distinct()
    so_far = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(
        F.col("end") - F.greatest("start", F.coalesce("reached", F.lit(0))), F.lit(0)
    )
    covered = (
        spans.withColumn("reached", reached)
        .groupBy("row")
        .agg(
            F.sum(fresh).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        )
    )
    none = F.array().cast(covered.schema["spans"].dataType)
    return (
        scanned.select("row", "id", "print", "n_words")
        .join(covered.join(listed, "row"), "row", "left")
        .select(
            "id", "print", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def decontaminated(df: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``df`` with ``n_hit`` and ``items`` of ``contamination``; these names are replaced."""
    found = contamination(df, items, id, text, **options).dropDuplicates(["id", "print"])
    found = found.select(F.col("id").alias("found_id"), F.col("print").alias("found_print"), "n_hit", "items")
    rows = packed(df, id=column(id), print=F.xxhash64(F.coalesce(column(text), F.lit(""))))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("print") == F.col("found_print"))
    return unpacked(rows.join(found, same), "n_hit", "items")
