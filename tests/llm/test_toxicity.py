from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import SF_DIR

from punctua.llm import queries, toxicity


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = queries.op4_toxicity(spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 and r.toxic == (r.score >= 0.5) == bool(r.predicted) for r in out)
    held = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    clean = [p for t, p in held if not t]
    assert np.mean([t == p for t, p in held]) > 0.92 and np.mean(clean) < 0.02


def test_held_out_recall_by_language(spark):
    """Toxic rows are found in every language, and both earlier categories occur in each."""
    sf_dir = SF_DIR.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    toxic = labels.where("toxic = 1").join(docs, "doc_id").select("doc_id", "lang").collect()
    language = {r.doc_id: r.lang for r in toxic}
    n, found, groups = Counter(), Counter(), Counter()
    for r in queries.op4_toxicity(spark, sf_dir).collect():
        if r.held_out and r.doc_id in language:
            n[language[r.doc_id]] += 1
            found[language[r.doc_id]] += r.predicted
            for p in ("p_insult", "p_contempt"):
                groups[language[r.doc_id], p] += r[p] >= 0.5
    assert set(n) == {"en", "de", "es", "fr"} and min(n.values()) > 10
    assert found.total() / n.total() > 0.85
    assert all(found[x] / n[x] > 0.75 for x in n), (n, found)
    assert all(groups[x, p] > 0 for x in n for p in ("p_insult", "p_contempt")), groups


def test_chain_uses_earlier_categories(spark, rows, tmp_path):
    """A later category that follows from an earlier one alone is learned through it."""
    rng = np.random.default_rng(1)
    data = []
    for i in range(600):
        found = [j for j in range(6) if rng.random() < 0.3]
        insult = float(0 in found or 1 in found)
        data.append((found, i % toxicity.FOLDS, insult, float(rng.random() < 0.3), insult))
    training = rows(
        "found array<int>, fold bigint, y_insult double, y_contempt double, y_toxic double", data
    )
    models = toxicity.fit_chain(training, {"found": 6}, str(tmp_path))
    assert [len(models[c]) for c in toxicity.CHAIN] == [7, 8, 9]
    assert models["toxic"][6] > 1  # weight of the probability of "insult"


def test_categories_follow_the_labels(rows):
    """Other toxic words, in two languages: both categories are found in each, with no word given."""
    rng = np.random.default_rng(2)
    toxic_words = {"xx": ("zorp", "blick", "quax"), "yy": ("grumo", "velka")}
    docs, labels = [], []
    for i in range(600):
        language = "xx" if i % 3 else "yy"
        plain = [f"{language}w{rng.integers(40)}" for _ in range(12)]
        toxic = i % 4 == 0
        own = list(rng.permutation(toxic_words[language])[: 1 + i % 2]) if toxic else []
        docs.append((i, " ".join([*plain, *own]), language))
        labels.append((i, int(toxic)))
    df = rows("doc_id int, text string, lang string", docs)
    out = toxicity.toxicity_scores(df, rows("doc_id int, toxic int", labels), language="lang").collect()
    toxic = {i for i, t in labels if t}
    for language in toxic_words:
        own = [r for r in out if docs[r.id][2] == language]
        for p in ("p_insult", "p_contempt"):
            assert any(r[p] > 0.5 for r in own if r.id in toxic)
            assert all(r[p] < 0.5 for r in own if r.id not in toxic)
        # every toxic text is one of a category, and the two are not the same
        assert all(max(r.p_insult, r.p_contempt) > 0.5 for r in own if r.id in toxic)
        assert any((r.p_insult > 0.5) != (r.p_contempt > 0.5) for r in own)
    assert all(r.toxic == (r.id in toxic) for r in out)


def test_signs():
    got = toxicity._signs("Badword badword! bad")
    assert {"badword", "bad", "badw*1", "badw*2"} <= got and "badw*3" not in got
    assert toxicity._signs(None) == set()


def test_nulls_repeats_and_empty_tables(rows):
    data = [(1, "you idiot"), (1, "you idiot"), (2, None), (3, ""), (None, "idiot"), (5, "fine words")]
    df = rows("doc_id int, text string", data)
    df = df.withColumns({"score": df.text, "id": df.text, "label": df.text, "found": df.text})
    labels = rows("doc_id int, toxic int, body string", [(1, 1, ""), (5, 0, ""), (5, 0, ""), (3, None, ""), (None, 1, "")])
    out = toxicity.toxicity_scores(df, labels).collect()
    assert len(out) == len(data)
    none = rows("doc_id int, toxic int", [])
    assert all(r.predicted == 0 for r in toxicity.toxicity_scores(df, none).collect())
    assert toxicity.toxicity_scores(rows("doc_id int, text string", []), labels).collect() == []


def test_presence_equals_signs():
    """Looking at a vocabulary's beginnings only finds what all signs of the text would."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["zorpig", "zorpiga", "zorp", "Zorpes", "blickt", "blickte", "xy"], 9)) for _ in range(40)]
    texts += [None, "", "zorpig " * 50_000]
    every = sorted(set().union(*map(toxicity._signs, texts)))
    vocabularies = {"found": every[::2], "found_without0": every[1::3], "found_without1": []}
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "body": texts})
    (out,) = toxicity._presence(vocabularies)(iter([batch]))
    assert out.schema.names == ["id", *vocabularies]
    for name, words in vocabularies.items():
        wanted = [[i for i, w in enumerate(words) if w in toxicity._signs(t)] for t in texts]
        assert out.column(name).to_pylist() == wanted


def test_a_fold_chooses_without_its_rows(spark, rows, tmp_path):
    """A sign that only one fold's toxic texts have is in no vocabulary and no group made without it."""
    data = []
    for i in range(240):
        fold, toxic = i % toxicity.FOLDS, i % 4 == 0
        data.append((" ".join([f"plain{i % 7}", *([f"only{fold}", "all"] if toxic else [])]), int(toxic), fold, "xx"))
    training = rows("body string, label int, fold bigint, language string", data)
    words = toxicity.choose_vocabularies(training, 100, str(tmp_path))
    assert {"all", "only0", "only1", "only2"} <= set(words["found"])
    schema = "label int, fold bigint, language string, " + ", ".join(f"{n} array<int>" for n in words)
    marked = training.mapInArrow(toxicity._presence(words), schema)
    for fold in range(toxicity.FOLDS):
        own = words[f"found_without{fold}"]
        assert f"only{fold}" not in own and {"all", f"only{(fold + 1) % 3}"} <= set(own)
        seen = [(t, y) for t, y, f, _ in data if f != fold]
        strength = {}
        for w in set().union(*(toxicity._signs(t) for t, _ in seen)):
            has = [y for t, y in seen if w in toxicity._signs(t)]
            if sum(has) >= toxicity.LEAST_TEXTS:
                strength[w] = toxicity._strength(sum(has), len(has), sum(y for _, y in seen), len(seen))
        assert own == sorted(strength, key=lambda w: (-strength[w], w))[:100]
        targets = toxicity.with_targets(marked, fold)
        assert {f"y_{c}_without{fold}" for c in toxicity.CHAIN} <= set(targets.columns)
