"""Token ids as binary files: one compressed frame a document, found by an offset index.

A set of token files is a folder with

- ``dictionary``: one file, a zstandard dictionary trained on the id arrays of short documents;
- ``files``: documents in ascending id order, file after file by part number;
- ``manifest``: a Parquet table with a row per file (ids, documents, tokens, first place).

A file is a row of records, each followed by a line feed (Spark's text writer puts a value's
bytes as they are and ends it so; thus files are committed by task, in any store): a header
(MAGIC, SHA-256 of the dictionary, bytes per id), the documents' frames, the index and the
footer (place and size of the index, MAGIC). A frame holds the ids of one document as
little-endian unsigned integers and is compressed alone with the common dictionary, so that a
short document compresses well and is read without its neighbours. The index is a frame of
its own: document count, then for all documents whether the id is known, id, place of the
frame and number of tokens.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctua.llm import texts
from punctua.llm.rows import column, new_folder, prepare_workers, written

MAGIC = b"TOKFILE1"
HEADER = struct.Struct("<8s32sB")
FOOTER = struct.Struct("<QQ8s")
LEVEL = 3
FILE_BYTES = 8 << 20  # of a file, which a task reads whole; less where that leaves cores idle
LEAST_BYTES = 1 << 20
SAMPLE = 2000  # documents the dictionary is trained on, at most
SAMPLE_BYTES = 4096  # length of their texts, at most
DICTIONARY_BYTES = 64 << 10
KEPT = 3 << 17  # words whose ids a worker keeps before it starts anew
LONGEST_KEPT = 128  # bytes of such a word
JOINED = 50  # words of a text for the library
MARK = b"\x01"
PLAIN_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("÷", "")
PLAIN = re.compile(f"([{PLAIN_LETTERS}]+)([.,;:!?]*)").fullmatch
BLOCK_IDS = 1 << 19  # ids read back at once


class WordwiseEncoder:
    """Ids of texts by a tokenizer of the library that sees white space as a border only.

    Of such a tokenizer a text's ids are those of its words one after the other, so the library
    is asked once for each word. Words of plain small letters, and marks of punctuation after
    them, are whole pieces already and go to the library's merging itself; other words go through
    all of it, many as one text, with a MARK of its own token between any two. Words are cut at
    ASCII blanks; all else, other white space and special tokens included, is left to the library.
    """

    def __init__(self, tokenizer_json: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        size = self.tokenizer.get_vocab_size()
        self.width = id_bytes(size, end_id)
        self.end = b"" if end_id is None else end_id.to_bytes(self.width, "little")
        self.packed = [i.to_bytes(self.width, "little") for i in range(size)]
        self.known: dict[bytes, bytes] = {}
        self.folds = "Lowercase" in str(self.tokenizer.normalizer)
        mark = self._library([MARK.decode()])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.letters = self._plain_letters()

    def _library(self, bodies: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(bodies, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}") for e in found]

    def _merged(self, piece: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.tokenizer.model.tokenize(piece)])

    def _plain_letters(self) -> dict[int, str] | None:
        """How the tokenizer spells the letters of PLAIN; None if it does more than that to words."""
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return None
        letters, marks = PLAIN_LETTERS, ".,;:!?"
        normal = self.tokenizer.normalizer.normalize_str
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        spelled = {ord(c): "".join(p for p, _ in cut(c)) for c in letters}
        whole = [p for p, _ in cut(normal(letters + marks))]
        if normal(letters) != letters or whole != [letters.translate(spelled), marks]:
            return None
        words = [letters[i : i + 7] for i in range(len(letters))]
        through = [i.tobytes() for i in self._library([w + marks for w in words])]
        merged = [self._merged(w.translate(spelled)) + self._merged(marks) for w in words]
        return spelled if through == merged else None

    def _plain(self, word: bytes) -> bytes | None:
        match = PLAIN(word.decode())
        if match is None:
            return None
        letters, marks = match.groups()
        base = self.known.get(word[: len(word) - len(marks)]) if marks else None
        if base is None:
            base = self._merged(letters if letters.isascii() else letters.translate(self.letters))
        return base + self._merged(marks) if marks else base

    def _ids(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        rest = words
        if self.letters is not None:
            rest = []
            for word in words:
                ids = self._plain(word)
                if ids is None:
                    rest.append(word)
                else:
                    yield word, ids
        alone = [w for w in rest if self.mark is None or MARK in w]
        if alone:
            ids = self._library([w.decode() for w in alone])
            yield from zip(alone, (i.tobytes() for i in ids), strict=True)
            rest = [w for w in rest if MARK not in w] if self.mark is not None else []
        groups = [rest[i : i + JOINED] for i in range(0, len(rest), JOINED)]
        between = b" " + MARK + b" "
        for group, ids in zip(groups, self._library([between.join(g).decode() for g in groups]), strict=True):
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(group) - 1:
                raise ValueError("the tokenizer does not see white space as a border only")
            raw, w = ids.tobytes(), self.width
            starts = [0, *((cuts + 1) * w).tolist()]
            ends = [*(cuts * w).tolist(), len(raw)]
            yield from zip(group, (raw[a:b] for a, b in zip(starts, ends, strict=True)), strict=True)

    def _lower(self, body: bytes) -> bytes:
        """A-Z as a-z where the tokenizer does the same later, so that fewer words differ.

        It composes letters and marks before; marks that compose with ASCII letters are those from
        U+0300 to U+033F, whose first byte no other character has. Special tokens keep their case.
        """
        return body.lower() if self.folds and b"\xcc" not in body and b"<|" not in body else body

    def encode(self, bodies: Sequence[str]) -> list[bytes]:
        """Ids of each text, the end id last, in ``width`` bytes each."""
        out = []
        for _, block in texts.blocks([b.encode() for b in bodies]):
            words = [self._lower(body).split() for body in block]
            different = set().union(*words)
            new = different.difference(self.known)
            if len(self.known) + len(new) > KEPT:  # what this block uses stays
                self.known = {w: self.known[w] for w in different - new}
            self.known.update(self._ids(list(new)))
            out += [b"".join(map(self.known.__getitem__, w)) + self.end for w in words]
            for word in new:
                if len(word) > LONGEST_KEPT:
                    del self.known[word]
        return out


def id_bytes(vocabulary: int, end_id: int | None = None) -> int:
    return 2 if max(vocabulary - 1, end_id or 0) < 1 << 16 else 4


@cache
def _encoder(tokenizer_json: str, end_id: int | None) -> WordwiseEncoder:
    return WordwiseEncoder(tokenizer_json, end_id)


@cache
def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    """A trained dictionary, or any other bytes as common content; none of nothing."""
    return zstandard.ZstdCompressionDict(content) if content else None


@cache
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    shared = _dictionary(content)
    if shared is not None:
        shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


@cache
def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(content))


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary of ``size`` bytes; of too few samples their own bytes serve."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def pack_file(documents: Iterator[list[tuple]], dictionary: bytes, width: int) -> Iterator[list[bytes]]:
    """Records of one file from lists of (id or None, number of tokens, frame)."""
    place, entries = 0, []
    for block in documents:
        out = []
        if not place:
            out.append(HEADER.pack(MAGIC, hashlib.sha256(dictionary).digest(), width))
            place = HEADER.size + 1
        for id, n, frame in block:
            entries.append((id is not None, id or 0, place, n))
            out.append(frame)
            place += len(frame) + 1
        yield out
    if entries:
        known, *rest = zip(*entries, strict=True)
        table = np.array(known, np.uint8).tobytes() + b"".join(np.array(r, "<i8").tobytes() for r in rest)
        index = zstandard.ZstdCompressor(level=LEVEL).compress(struct.pack("<Q", len(entries)) + table)
        yield [index, FOOTER.pack(place, len(index), MAGIC)]


class TokenFile:
    """Index of a file's bytes; frames are decompressed on demand."""

    def __init__(self, content: bytes | pa.Buffer, dictionary: bytes):
        content = memoryview(content)
        magic, digest, self.width = HEADER.unpack_from(content)
        at, size, tail = FOOTER.unpack_from(content, len(content) - FOOTER.size - 1)
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("no token file, or one cut short")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        self.content, self.frames = content, _decompressor(dictionary)
        index = zstandard.ZstdDecompressor().decompress(content[at : at + size])
        (count,) = struct.unpack_from("<Q", index)
        known = np.frombuffer(index, np.uint8, count, 8)
        ids, places, self.n_tokens = np.frombuffer(index, "<i8", 3 * count, 8 + count).reshape(3, count)
        self.ids = pa.array(ids, mask=known == 0)
        self.places = np.append(places, at)

    def read(self, i: int) -> bytes:
        """Ids of the file's document ``i`` as little-endian unsigned 32-bit integers."""
        raw = self.frames.decompress(self.content[self.places[i] : self.places[i + 1] - 1])
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4").tobytes()


def _sampled(rows: DataFrame, count: int) -> DataFrame:
    """Texts to train on: short ones, first by hash, about ``SAMPLE``."""
    short = rows.filter(F.octet_length("body").between(1, SAMPLE_BYTES))
    order = F.xxhash64("id", "body")
    spread = short.withColumn("order", order).filter(F.pmod("order", F.lit(max(1, count // (2 * SAMPLE)))) == 0)
    return spread.orderBy("order").limit(SAMPLE).select("body")


def write_token_files(
    df: DataFrame, tokenizer_file: str, target: str, id: str = "doc_id", text: str = "text",
    end_id: int | None = 1, file_bytes: int = FILE_BYTES,
) -> str:
    """Encode the texts of ``df`` and write them as token files into the new folder ``target``.

    Each document ends with ``end_id``, if given. Documents stand in ascending order of ``id``
    (whole numbers; null first), those that tie by a hash of their text. A null text counts as
    empty and has the end id only; repeated rows are documents of their own; an empty table
    gives a set without documents. Other columns are not read. The tokenizer must treat white
    space as ``WordwiseEncoder`` says; its file is read on the driver. The dictionary is trained
    on at most ``SAMPLE`` documents of at most ``SAMPLE_BYTES`` bytes; it bears on sizes only.
    Frames are made before the shuffle, so this moves compressed ids, not texts.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    folder = new_folder(df, "token-files")
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = f.read()
    body = F.coalesce(column(text), F.lit(""))
    rows = df.select(column(id).cast("long").alias("id"), body.alias("body"))
    shared = spark.sparkContext.broadcast(tokenizer)
    width = _encoder(tokenizer, end_id).width

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, end_id)
        for batch in batches:
            ids = encoder.encode(batch.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    samples = _sampled(rows, rows.count()).mapInArrow(coded, "ids binary").collect()
    dictionary = train_dictionary([bytes(r.ids) for r in samples])
    content = spark.sparkContext.broadcast(dictionary)

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, frames = _encoder(shared.value, end_id), _compressor(content.value)
        for batch in batches:
            ids = encoder.encode(batch.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("print"),
                    pa.array([len(i) // encoder.width for i in ids], pa.int64()),
                    pa.array([frames.compress(i) for i in ids], pa.binary()),
                ],
                names=["id", "print", "n", "frame"],
            )

    frames = rows.withColumn("print", F.xxhash64("body")).mapInArrow(
        compressed, "id bigint, print bigint, n bigint, frame binary"
    )
    frames = written(frames, folder, "frames")
    size = frames.agg(F.coalesce(F.sum(F.octet_length("frame")), F.lit(0))).first()[0]
    files = max(-(-size // file_bytes), min(spark.sparkContext.defaultParallelism, size // LEAST_BYTES), 1)
    # repeated rows are told apart by their place, so that they need not meet in one file
    order = ("id", "print", "path", "place")
    placed = frames.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"))
    ordered = placed.repartitionByRange(int(files), *order).sortWithinPartitions(*order)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = (
            list(zip(*(b.column(c).to_pylist() for c in ("id", "n", "frame")), strict=True)) for b in batches
        )
        for records in pack_file(documents, content.value, width):
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    records = ordered.select("id", "n", "frame").mapInArrow(filed, "record binary")
    _raw(spark.createDataFrame([(dictionary,)], "record binary"), f"{target}/dictionary")
    _raw(records, f"{target}/files")
    _manifest(spark, target).write.parquet(f"{target}/manifest")
    return target


def _raw(records: DataFrame, path: str) -> None:
    records.select(F.col("record").cast("string")).write.text(path)


def _contents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).filter("length > 0").select("path", "content")


def read_dictionary(spark: SparkSession, target: str) -> bytes:
    rows = _contents(spark, f"{target}/dictionary").collect()
    return b"".join(bytes(r.content) for r in rows)[:-1]


def part_number(path: Column) -> Column:
    return F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).cast("long")


def running_totals(df: DataFrame, order: str, value: str, block: int = 4096) -> DataFrame:
    """``df`` with ``start``, the sum of ``value`` over rows of smaller ``order`` (0, 1, ...).

    By blocks of places first, so that no task sorts all rows.
    """
    numbered = df.withColumn("block", F.floor(F.col(order) / block))
    sums = numbered.groupBy("block").agg(F.sum(value).alias("sum"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return numbered.join(sums, "block").withColumn("start", start).drop("block", "base")


def _manifest(spark: SparkSession, target: str) -> DataFrame:
    """A row per file, from the indexes: path, number, first_id, last_id, documents, tokens, start."""
    content = spark.sparkContext.broadcast(read_dictionary(spark, target))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                f = TokenFile(raw.as_buffer(), content.value)
                known = f.ids.drop_null().to_pylist()
                ends = (known[0], known[-1]) if known else (None, None)
                rows.append((path, *ends, len(f.ids), int(f.n_tokens.sum())))
            kinds = (pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=["path", "first_id", "last_id", "documents", "tokens"],
            )

    schema = "path string, first_id bigint, last_id bigint, documents bigint, tokens bigint"
    files = _contents(spark, f"{target}/files").mapInArrow(listed, schema)
    files = written(files.withColumn("number", part_number(F.col("path"))), new_folder(files, "manifest"), "files")
    return running_totals(files, "number", "tokens")


def _documents(dictionary: Callable[[], bytes], wanted: frozenset | None):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("number", pa.int64()), ("id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        for batch in batches:
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                f = TokenFile(raw.as_buffer(), dictionary())
                number = int(re.search(r"/part-(\d+)[^/]*$", path)[1])
                before = np.cumsum(f.n_tokens) - f.n_tokens
                ids = f.ids.to_pylist()
                chosen = [i for i in range(len(ids)) if wanted is None or ids[i] in wanted]
                rows, held = [], 0
                for i in chosen:
                    n = int(f.n_tokens[i])
                    rows.append((number, ids[i], int(before[i]), n, f.read(i)))
                    held += n
                    if held >= BLOCK_IDS or i == chosen[-1]:
                        columns = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k.type) for c, k in zip(columns, schema, strict=True)], schema=schema
                        )
                        rows, held = [], 0

    return unpack


def _read(spark: SparkSession, target: str, paths: str | list[str], wanted: frozenset | None) -> DataFrame:
    content = spark.sparkContext.broadcast(read_dictionary(spark, target))
    return _contents(spark, paths).mapInArrow(
        _documents(lambda: content.value, wanted),
        "number bigint, id bigint, before bigint, n_tokens bigint, ids binary",
    )


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """All documents of a set: id, start (tokens of all documents before it), n_tokens, ids.

    ``ids`` holds little-endian unsigned 32-bit integers. Files are read whole, each by one task.
    """
    prepare_workers(spark)
    files = spark.read.parquet(f"{target}/manifest").select("number", "start")
    documents = _read(spark, target, f"{target}/files", None)
    return documents.join(files, "number").select(
        "id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def find_documents(spark: SparkSession, target: str, ids: Sequence[int]) -> DataFrame:
    """As ``read_token_files``, for a list of ids: only files that can hold one are read, and
    only the frames of these documents are decompressed."""
    prepare_workers(spark)
    wanted = F.array(*(F.lit(int(i)).cast("long") for i in ids))
    files = spark.read.parquet(f"{target}/manifest").filter(
        F.exists(wanted, lambda i: i.between(F.col("first_id"), F.col("last_id")))
    )
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return read_token_files(spark, target).limit(0)
    return _read(spark, target, paths, frozenset(ids)).join(files.select("number", "start"), "number").select(
        "id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids"
    )
