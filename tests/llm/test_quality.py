from __future__ import annotations

import zlib

import numpy as np
from conftest import SF_DIR
from hypothesis import given
from hypothesis import strategies as st

from punctua.llm import quality, queries


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = queries.op9_quality(spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95


def test_id_and_other_columns_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    plain = {r.id: r.score for r in quality.quality_scores(docs.select("doc_id", "text"), labels).collect()}
    moved = docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 1_000_000).withColumn("lang", docs.source))
    again = {r.id: r.score for r in quality.quality_scores(moved, labels).collect()}
    assert all(abs(again[i] - s) < 1e-6 and abs(again[i + 1_000_000] - s) < 1e-6 for i, s in plain.items())


def test_nulls_repeats_and_clashing_columns(rows):
    data = [(1, "good words stand here."), (2, "### $$$ &&&"), (2, "### $$$ &&&"), (3, None), (4, ""), (None, "x")]
    df = rows("doc_id int, text string", data)
    df = df.withColumns({"score": df.text, "id": df.text, "label": df.text, "row": df.doc_id})
    labels = rows(
        "doc_id int, quality int, text string",
        [(1, 1, ""), (2, 0, ""), (2, 0, ""), (4, None, ""), (None, 1, ""), (99, 1, "")],
    )
    out = quality.with_quality(df, labels).collect()
    assert len(out) == len(data) and all(0 <= r.score <= 1 for r in out)
    assert set(out[0].asDict()) == set(df.columns) | {"predicted"}
    score = {r.doc_id: r.score for r in out}
    assert score[1] > score[2]


def test_empty_tables(rows):
    df, labels = rows("doc_id int, text string", []), rows("doc_id int, quality int", [])
    assert quality.quality_scores(df, labels).collect() == []
    some = quality.quality_scores(rows("doc_id int, text string", [(1, "a")]), labels).first()
    assert (some.score, some.predicted) == (0.5, 0)


@given(st.lists(st.tuples(st.integers(1, 9), st.floats(0, 1)), min_size=1, max_size=12))
def test_isotonic_is_the_best_monotone_fit(points):
    weight = np.array([w for w, _ in points], float)
    positive = weight * np.array([p for _, p in points])
    fit = quality.isotonic(weight, positive)
    assert np.all(np.diff(fit) >= -1e-9)
    # min-max formula of the isotonic fit
    n = len(points)
    best = [
        max(
            min(positive[a : b + 1].sum() / weight[a : b + 1].sum() for b in range(i, n))
            for a in range(i + 1)
        )
        for i in range(n)
    ]
    assert np.allclose(fit, best)


def test_fourier_features_approach_the_kernel():
    rng = np.random.default_rng(0)
    size, n = 20_000, len(quality.STATISTICS)
    directions = rng.normal(size=(n, size)) / (quality.WIDTH * np.sqrt(n))
    model = quality.Model(
        np.zeros(n), np.ones(n), directions, rng.uniform(0, 2 * np.pi, size),
        np.zeros(size + 1), np.zeros(1), np.zeros(1),
    )
    x = rng.normal(size=(5, n))
    z = model.features(x)[:, 1:]
    far = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.allclose(z @ z.T, np.exp(-far / (2 * n * quality.WIDTH**2)), atol=0.05)
