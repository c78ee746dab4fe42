"""Quality scores from document statistics.

Random Fourier features turn a Gaussian kernel over the statistics into a linear model.
Every partition sums its part of the normal equations, Spark adds the sums, and ridge
regression is solved on the driver, whose matrices have the size of the model. Isotonic
regression over score bins makes probabilities of the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm import texts
from punctua.llm.rows import column, extended, new_folder, packed, prepare_workers, unpacked, written

FEATURES = 192  # random Fourier features
WIDTH = 1.5  # of the kernel, in units of the root of the number of statistics
RIDGE = 1e-3  # share of the mean diagonal
BINS = 512  # of the calibration
SEED = 9

# Kinds of bytes that are counted.
KINDS = {
    "lower": range(0x61, 0x7B),
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "blank": [0x20, 0x09],
    "line": [0x0A],
    "stop": b".,;:?'\"-()",
    "bang": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "beyond": range(0x80, 0x100),
}
STATISTICS = (
    "log_words", "log_bytes", "word_length", "word_spread", "distinct_words", "top_word",
    "repeated_runs", "bare_symbols", "line_length", "repeated_lines", "upper_words",
    "marked_words", *KINDS,
)


def _kind_table() -> np.ndarray:
    table = np.full(256, len(KINDS), np.uint8)
    for i, members in enumerate(KINDS.values()):
        table[list(members)] = i
    return table


def statistics(bodies: list[bytes]) -> np.ndarray:
    """One row of figures for each text (UTF-8, case as it is); zeros for an empty one."""
    table, out = _kind_table(), []
    letters = texts.byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B),
                                *range(0x80, 0x100)])
    upper = texts.byte_table(KINDS["upper"])
    marks = texts.byte_table([*b"!#$%&*+|<=>@^_~"])
    for _, block in texts.blocks(bodies):
        w = texts.words(block, texts.NOT_SPACE)
        buffer = np.frombuffer(w.data, np.uint8)
        length = (w.end - w.start).astype(float)
        sums = [np.concatenate(([0], np.cumsum(t[buffer]))) for t in (letters, upper, marks)]
        n_letters, n_upper, n_marks = (s[w.end] - s[w.start] for s in sums)
        run_first, run_codes = texts.runs(w, 3)
        run_bounds = np.searchsorted(w.doc[run_first], np.arange(len(block) + 1))
        bounds = np.concatenate(([0], np.cumsum(w.per_doc)))
        for d, body in enumerate(block):
            a, b = bounds[d], bounds[d + 1]
            n = b - a
            kinds = np.bincount(table[np.frombuffer(body, np.uint8)], minlength=len(KINDS) + 1)
            size = max(len(body), 1)
            if n:
                _, often = np.unique(w.code[a:b], return_counts=True)
                runs = run_codes[run_bounds[d] : run_bounds[d + 1]]
                lines = [x for x in body.split(b"\n") if x.strip()]
                words = length[a:b]
                row = [
                    np.log1p(n), np.log1p(len(body)), words.mean(), words.std(),
                    len(often) / n, often.max() / n,
                    1 - len(np.unique(runs)) / max(len(runs), 1) if len(runs) else 0.0,
                    np.mean(n_letters[a:b] == 0), np.log1p(n / max(len(lines), 1)),
                    1 - len(set(lines)) / max(len(lines), 1),
                    np.mean((n_upper[a:b] == n_letters[a:b]) & (n_letters[a:b] > 1)),
                    np.mean(n_marks[a:b] > 0),
                ]
            else:
                row = [0.0] * 12
            out.append([*row, *(kinds[: len(KINDS)] / size)])
    return np.array(out, float).reshape(len(bodies), len(STATISTICS))


@dataclass(frozen=True)
class Model:
    """Ridge weights over Fourier features of scaled statistics, and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack((np.ones((len(x), 1)), waves))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Probabilities; between the middles of two steps they are interpolated."""
        return np.clip(np.interp(self.raw(stats), self.edges, self.values), 0.0, 1.0)


def held_out(id: Column) -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def isotonic(weight: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing shares nearest to positive / weight, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for w, p in zip(weight, positive, strict=True):
        pools.append([float(w), float(p), 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), p / w) for w, p, k in pools]) if pools else np.zeros(0)


def _matrix(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(STATISTICS))


def _normal_sums(model: Model):
    """Rows (i, sums) of one partition's Z'[Z y] and of its number of rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.phases) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            total += z.T @ np.hstack((z, y[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
            names=["i", "sums"],
        )

    return add


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The partitions' rows (i, sums) added up by Spark; ``size`` rows come to the driver."""
    columns = [F.sum(F.element_at("sums", j + 1)).alias(f"s{j}") for j in range(size + 1)]
    total = np.zeros((size, size + 1))
    for row in parts.groupBy("i").agg(*columns).collect():
        total[row[0]] = row[1:]
    return total


def _binned(model: Model, low: float, high: float):
    def bin_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, positive = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            at = np.clip((model.raw(_matrix(batch)) - low) / (high - low) * BINS, 0, BINS - 1)
            np.add.at(weight, at.astype(int), 1)
            np.add.at(positive, at.astype(int), y)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BINS, dtype=np.int32)), pa.array(weight), pa.array(positive)],
            names=["bin", "weight", "positive"],
        )

    return bin_


def document_statistics(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, print, stats) of every row; ``print`` is a hash of the text."""
    prepare_workers(df.sparkSession)
    body = F.coalesce(column(text), F.lit(""))
    source = df.select(column(id).alias("id"), F.xxhash64(body).alias("print"), body.alias("body"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics([t.encode() for t in batch.column("body").to_pylist()])
            offsets = pa.array(np.arange(len(stats) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("print"),
                 pa.ListArray.from_arrays(offsets, pa.array(stats.ravel()))],
                names=["id", "print", "stats"],
            )

    schema = extended(source.select("id", "print"), "stats array<double>")
    return source.mapInArrow(measure, schema)


def fit(training: DataFrame) -> Model:
    """Model of (stats, label 0 or 1). Constant score 0.5 without training rows.

    Every row counts; only sums whose size is that of the model leave the executors.
    """
    n_stats = len(STATISTICS)
    moments = training.agg(
        F.count("*").alias("n"),
        F.sum("label").alias("positive"),
        *(F.avg(F.element_at("stats", j + 1)).alias(f"m{j}") for j in range(n_stats)),
        *(F.stddev_pop(F.element_at("stats", j + 1)).alias(f"s{j}") for j in range(n_stats)),
    ).first()
    generator = np.random.default_rng(SEED)
    directions = generator.normal(size=(n_stats, FEATURES)) / (WIDTH * np.sqrt(n_stats))
    phases = generator.uniform(0, 2 * np.pi, FEATURES)
    n = moments["n"]
    mean = np.array([moments[f"m{j}"] or 0.0 for j in range(n_stats)])
    scale = np.array([moments[f"s{j}"] or 0.0 for j in range(n_stats)])
    scale[scale < 1e-9] = 1.0
    nothing = np.zeros(FEATURES + 1)
    model = Model(mean, scale, directions, phases, nothing, np.array([0.0]), np.array([0.5]))
    if not n:
        return model
    size = FEATURES + 1
    schema = "i int, sums array<double>"
    sums = _added(training.mapInArrow(_normal_sums(model), schema), size)
    gram, right = sums[:, :size], sums[:, size]
    penalty = RIDGE * np.trace(gram) / size * np.eye(size)
    penalty[0, 0] = 1e-9
    weights = np.linalg.solve(gram + penalty, right)
    model = Model(mean, scale, directions, phases, weights, model.edges, model.values)
    low, high = -0.5, 1.5
    bins = (
        training.mapInArrow(_binned(model, low, high), "bin int, weight double, positive double")
        .groupBy("bin")
        .agg(F.sum("weight").alias("weight"), F.sum("positive").alias("positive"))
        .filter("weight > 0")
        .orderBy("bin")
        .collect()
    )
    middle = low + (np.array([b["bin"] for b in bins]) + 0.5) * (high - low) / BINS
    weight = np.array([b["weight"] for b in bins])
    positive = np.array([b["positive"] for b in bins])
    values = isotonic(weight, positive)
    return Model(mean, scale, directions, phases, weights, middle, values)


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.7,
) -> DataFrame:
    """One row (id, print, held_out, score, predicted) for each row of ``df``.

    Trains on labels whose id is not held out. Only the text is an input of a score; the
    id decides about training. Null and empty texts have all statistics 0 and are scored
    like any other; null labels and labels without document are left out; repeated labels
    and documents count as often as they occur. Without training rows every score is 0.5.
    ``print`` is a hash of the text. Rows with a null id are scored, not trained on.
    """
    folder = new_folder(df, "quality")
    measured = written(document_statistics(df, id, text), folder, "statistics")
    known = labels.select(column(id).alias("id"), column(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isNotNull() & ~held_out(F.col("id")))
    training = measured.select("id", "stats").join(known, "id").select("stats", "label")
    model = fit(written(training, folder, "training"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("print"), pa.array(model.score(_matrix(batch)))],
                names=["id", "print", "score"],
            )

    schema = extended(measured.select("id", "print"), "score double")
    return measured.mapInArrow(score, schema).select(
        "id", "print", held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def with_quality(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``df`` with ``score`` and ``predicted``; columns of these names are replaced."""
    found = quality_scores(df, labels, id, text, **options).dropDuplicates(["id", "print"])
    found = found.select(F.col("id").alias("found_id"), F.col("print").alias("found_print"), "score", "predicted")
    rows = packed(df, id=column(id), print=F.xxhash64(F.coalesce(column(text), F.lit(""))))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("print") == F.col("found_print"))
    return unpacked(rows.join(found, same), "score", "predicted")
