"""Toxicity by a chain of linear classifiers.

Classifier chain: the categories are predicted one after the other, and each later model
also sees the probabilities of the earlier categories. It is trained with out-of-fold
probabilities, that is, with those of models that have not seen the row, as it will meet
such probabilities later.

The models are logistic regressions over the presence of words and of word beginnings, a
beginning also by whether several words of the text have it. The vocabulary is chosen over
all training rows by how much more often toxic texts have such a sign; what the models that
give the out-of-fold probabilities see (vocabulary, categories, weights) is chosen without
the fold.

The earlier categories come from the training labels: in each language the strong signs are
parted into two groups by the toxic texts they share, see ``sign_groups``. No word is given.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.rows import column, extended, new_folder, prepare_workers, written

VOCABULARY = 512  # signs of the models
BEGINNINGS = (4, 5, 6, 7)  # letters of the beginnings
SEVERAL = (1, 2, 3, 5)  # words with the same beginning that make a sign
MOST_LABELS = 20_000  # bound of the training sample
LEAST_TEXTS = 3  # toxic training texts that must have a sign
FOLDS = 3
REGULARISATION = 1e-4
THRESHOLD = 0.5
WORD = re.compile(r"\w+")

# The labels only say whether a text is toxic. The last category of the chain is that label
# itself; the earlier ones are two groups of its texts, found by ``sign_groups``, and their
# names are no more than names of columns.
CATEGORIES = ("insult", "contempt")
CHAIN = (*CATEGORIES, "toxic")
STRONG = 0.5  # of the strength of a language's strongest sign


def _signs(text: str | None) -> set[str]:
    """Words, and beginnings with a star and the number of words that have them at least."""
    words = Counter(WORD.findall((text or "").lower()))
    found = set(words)
    for n in BEGINNINGS:
        heads: Counter = Counter()
        for word, times in words.items():
            if len(word) > n:
                heads[word[:n]] += times
        for head, times in heads.items():
            found.update(f"{head}*{least}" for least in SEVERAL if least <= times)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each fold, toxic or not, that have a sign."""
    for batch in batches:
        counts: dict[tuple[int, int], Counter] = defaultdict(Counter)
        rows = (batch.column(c).to_pylist() for c in ("body", "fold", "label"))
        for text, fold, label in zip(*rows, strict=True):
            counts[fold, int(bool(label))].update(_signs(text))
        for (fold, label), found in counts.items():
            times = np.fromiter(found.values(), np.int64, len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(np.full(len(found), fold)),
                 pa.array(times * label), pa.array(times * (1 - label))],
                names=["word", "fold", "toxic", "other"],
            )


def _presence(vocabularies: dict[str, list[str]]):
    """Adds a column for each vocabulary: the places of the signs that a text has.

    Only words and beginnings that some vocabulary has are looked at.
    """
    places: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for name, words in vocabularies.items():
        for i, w in enumerate(words):
            places[w].append((name, i))
    heads = {sign.partition("*")[0] for sign in places if "*" in sign}

    def found_in(text: str | None) -> dict[str, list[int]]:
        words = Counter(WORD.findall((text or "").lower()))
        begun: Counter = Counter()
        for word, times in words.items():
            for n in BEGINNINGS:
                if len(word) > n and (head := word[:n]) in heads:
                    begun[head] += times
        signs = [w for w in words if w in places]
        signs += [f"{head}*{least}" for head, times in begun.items() for least in SEVERAL if least <= times]
        out: dict[str, list[int]] = {name: [] for name in vocabularies}
        for sign in signs:
            for name, i in places.get(sign, ()):
                out[name].append(i)
        return {name: sorted(own) for name, own in out.items()}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [found_in(text) for text in batch.column("body").to_pylist()]
            kept = [i for i, n in enumerate(batch.schema.names) if n != "body"]
            added = [pa.array([own[name] for own in found], pa.list_(pa.int32())) for name in vocabularies]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), *added],
                names=[*(batch.schema.names[i] for i in kept), *vocabularies],
            )

    return mark


def _suffix(fold: int | None) -> str:
    """Of columns that are chosen without a fold; none for those that see all rows."""
    return "" if fold is None else f"_without{fold}"


def choose_vocabularies(training: DataFrame, size: int, folder: str) -> dict[str, list[str]]:
    """``found``: the ``size`` signs whose share among toxic texts exceeds that among others most.

    ``found_without<fold>``: the same, as chosen without the rows of a fold.
    ``training``: (body, label, fold). The order is by the signed root of the chi-square statistic,
    then by word. Texts are counted by sign and fold once.
    """
    schema = "word string, fold bigint, toxic bigint, other bigint"
    counted = training.select("body", "label", "fold").mapInArrow(_counted, schema)
    sums = []
    for fold in (None, *range(FOLDS)):
        for c in ("toxic", "other"):
            sums.append(F.sum(F.when(F.lit(fold is None) | (F.col("fold") != (fold or 0)), F.col(c)).otherwise(0)).alias(c + _suffix(fold)))
    # too few toxic texts of all folds are too few without one
    words = written(counted.groupBy("word").agg(*sums).filter(F.col("toxic") >= LEAST_TEXTS), folder, "signs")
    rows = {r.fold: (r.toxic or 0, r.n) for r in training.groupBy("fold").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).collect()}
    chosen = {}
    for fold in (None, *range(FOLDS)):
        seen = [rows[f] for f in rows if f != fold]
        n_toxic, n_all = sum(t for t, _ in seen), sum(n for _, n in seen)
        name = f"found{_suffix(fold)}"
        if not n_toxic or n_toxic == n_all:
            chosen[name] = []
            continue
        toxic, other = (F.col(c + _suffix(fold)) for c in ("toxic", "other"))
        expected = (toxic + other) * (n_toxic / n_all)
        strength = (toxic - expected) / F.sqrt(expected * (1 - n_toxic / n_all))
        best = (
            words.filter(toxic >= LEAST_TEXTS)
            .select("word", strength.alias("strength"))
            .orderBy(F.desc("strength"), "word")
            .limit(size)
            .collect()
        )
        chosen[name] = [r["word"] for r in best]
    return chosen


def _strength(toxic: int, both: int, n_toxic: int, n_all: int) -> float:
    """Signed root of the chi-square statistic, as in ``choose_vocabularies``."""
    expected = both * n_toxic / n_all
    return (toxic - expected) / (expected * (1 - n_toxic / n_all)) ** 0.5


def sign_groups(training: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """Two groups of signs for each language, from the training labels alone.

    ``training``: (language, label, found). A language's strong signs are those in
    ``LEAST_TEXTS`` of its toxic texts that are at least ``STRONG`` times as strong as its
    strongest. That one leads the first group. The sign in most toxic texts without it leads
    the second, or if there is no such text, the one that shares the smallest part of their
    toxic texts with it; if all strong signs have the same texts, the second group is empty.
    Any other strong sign goes to the leader with which it shares the larger part, in doubt
    to the first.
    Where all texts of a language have one label, there are no groups.

    The driver gets counts by language and sign, never texts.
    """
    totals = training.groupBy("language").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    n = {r.language: (r.toxic, r.n) for r in totals.collect() if 0 < r.toxic < r.n}
    signs = training.select("language", "label", "found", F.explode("found").alias("sign"))
    counted = signs.groupBy("language", "sign").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    strength: dict[str, dict[int, float]] = defaultdict(dict)
    toxic: dict[tuple[str, int], int] = {}
    for r in counted.filter(F.col("toxic") >= LEAST_TEXTS).collect():
        if r.language in n and (x := _strength(r.toxic, r.n, *n[r.language])) > 0:
            strength[r.language][r.sign], toxic[r.language, r.sign] = x, r.toxic
    strong = {}
    for language, own in strength.items():
        order = sorted(own, key=lambda s: (-own[s], s))
        strong[language] = [s for s in order if own[s] >= STRONG * own[order[0]]]

    def shared(leaders: dict[str, int]) -> Counter:
        """Toxic texts that have both a sign and the leader of their language."""
        rows = training.sparkSession.createDataFrame([*leaders.items()], "language string, leader int")
        both = signs.filter("label = 1").join(F.broadcast(rows), "language")
        both = both.filter(F.array_contains("found", F.col("leader"))).groupBy("language", "sign").count()
        return Counter({(r.language, r.sign): r["count"] for r in both.collect()})

    def part(language: str, sign: int, leader: int, common: Counter) -> float:
        both = common[language, sign]
        return both / (toxic[language, sign] + toxic[language, leader] - both)

    first = {language: order[0] for language, order in strong.items()}
    with_first = shared(first)
    second = {}
    for language, order in strong.items():
        more = {s: toxic[language, s] - with_first[language, s] for s in order}
        parts = {s: part(language, s, first[language], with_first) for s in order}
        best = max(order, key=more.get) if any(more.values()) else min(order, key=parts.get)
        if parts[best] < 1:
            second[language] = best
    with_second = shared(second)

    groups = {}
    for language, order in strong.items():
        later = set()
        if language in second:
            later = {
                s for s in order
                if part(language, s, second[language], with_second) > part(language, s, first[language], with_first)
            }
        groups[language] = ([s for s in order if s not in later], [s for s in order if s in later])
    return groups


def with_targets(training: DataFrame, fold: int | None = None) -> DataFrame:
    """Adds y_<category>: a toxic row with a sign of its language's group, and the label itself.

    With a ``fold`` the groups are found in the other folds, and the columns are named so.
    """
    more = _suffix(fold)
    seen = training if fold is None else training.filter(F.col("fold") != fold)
    seen = seen.select("language", "label", F.col(f"found{more}").alias("found"))
    found = [(language, *groups) for language, groups in sign_groups(seen).items()] if CATEGORIES else []
    schema = ", ".join(["language string", *(f"signs_{c} array<int>" for c in CATEGORIES)])
    groups = training.sparkSession.createDataFrame(found, schema)
    rows = training.join(F.broadcast(groups), "language", "left")
    targets = {
        f"y_{c}{more}": (
            F.coalesce(F.arrays_overlap(f"found{more}", f"signs_{c}"), F.lit(False)) & (F.col("label") == 1)
        ).cast("double")
        for c in CATEGORIES
    }
    targets[f"y_{CHAIN[-1]}{more}"] = F.col("label").cast("double")
    return rows.withColumns(targets).drop(*(f"signs_{c}" for c in CATEGORIES))


def _vector(size: int, earlier: list[str]):
    """Presence of each word as 0 or 1, then the probabilities of the earlier categories."""
    there = F.array().cast("array<double>") if not size else F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.array_contains("found", i).cast("double"),
    )
    return array_to_vector(F.concat(there, F.array(*(F.col(f"p_{c}") for c in earlier)))
                           if earlier else there)


def _fit(rows: DataFrame, category: str, size: int, earlier: list[str]) -> np.ndarray:
    """Weights and, last, the intercept; a constant category gets a constant answer."""
    table = rows.select(_vector(size, earlier).alias("features"), F.col(f"y_{category}").alias("label"))
    shares = table.agg(F.avg("label")).first()[0]
    if shares is None or shares in (0.0, 1.0):
        return np.append(np.zeros(size + len(earlier)), 12.0 if shares else -12.0)
    model = LogisticRegression(
        regParam=REGULARISATION, standardization=False, maxIter=30, tol=1e-5
    ).fit(table)
    return np.append(model.coefficients.toArray(), model.intercept)


def _probability(weights: np.ndarray, earlier: list[str], found: str = "found"):
    size = len(weights) - len(earlier) - 1
    w = F.lit([float(x) for x in weights[:size]]).cast("array<double>")
    logit = F.aggregate(
        found, F.lit(float(weights[-1])), lambda a, i: a + F.element_at(w, i + 1)
    )
    for c, x in zip(earlier, weights[size:-1], strict=True):
        logit = logit + F.col(f"p_{c}") * float(x)
    return 1 / (1 + F.exp(-logit))


def _without(training: DataFrame, fold: int) -> DataFrame:
    """The rows of the other folds, with the signs and targets that were chosen without this one."""
    others = training.filter(F.col("fold") != fold)
    own = {c.removesuffix(_suffix(fold)): F.col(c) for c in training.columns if c.endswith(_suffix(fold))}
    return others.withColumns(own) if own else others


def fit_chain(training: DataFrame, sizes: dict[str, int], folder: str) -> dict[str, np.ndarray]:
    """One weight vector for each category of the chain.

    ``training``: (found, fold, y_<category>...), and for each fold the same found and y columns as
    chosen without it (``_without<fold>``); where there are none, those of all rows serve.
    ``sizes``: of the vocabulary of each found column. Later models see out-of-fold probabilities.
    """
    models, earlier = {}, []
    for category in CHAIN:
        models[category] = _fit(training, category, sizes["found"], earlier)
        if category == CHAIN[-1]:
            break
        guess = F.lit(None).cast("double")
        for fold in range(FOLDS):
            found = f"found{_suffix(fold)}" if f"found{_suffix(fold)}" in sizes else "found"
            apart = _fit(_without(training, fold), category, sizes[found], earlier)
            guess = F.when(F.col("fold") == fold, _probability(apart, earlier, found)).otherwise(guess)
        training = written(training.withColumn(f"p_{category}", guess), folder, f"chain-{category}")
        earlier.append(category)
    return models


def toxicity_scores(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    keep_out=None,
    vocabulary: int = VOCABULARY,
    most_labels: int = MOST_LABELS,
    language: str | None = None,
) -> DataFrame:
    """One row (id, p_<category>..., score, predicted, toxic) for each row of ``df``.

    Trains on at most ``most_labels`` labels, those first by a hash of the id.
    ``keep_out``: condition on the id column ``id`` for labels that must not be trained on.
    ``language``: column by which the earlier categories are found apart; null is a language
    of its own, and without the column all rows are of one.
    Words are runs of letters, digits and ``_``, in lower case, of the whole text however long. ``score`` is the last
    probability of the chain, ``predicted`` 1 if it is at least 0.5. Null and empty texts
    have no words and get the models' intercepts. Null labels and labels without document
    are left out; repeated rows count as often as they occur; rows with null id are scored
    and not trained on. Without toxic training rows all scores are near 0.
    An empty table gives no rows; other columns, whatever their names, are not read.
    """
    prepare_workers(df.sparkSession)
    folder = new_folder(df, "toxicity")
    body = F.coalesce(column(text), F.lit(""))
    source = df.select(column(id).alias("id"), body.alias("body"))
    known = labels.select(column(id).alias("id"), column(label).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isNotNull())
    if keep_out is not None:
        known = known.filter(~keep_out(F.col("id")))
    # Two numbers a row and ``most_labels`` rows at most: small enough to send to every task.
    sample = known.orderBy(F.xxhash64("id"), "id", "label").limit(most_labels)
    spoken = F.coalesce(column(language).cast("string"), F.lit("")) if language else F.lit("")
    texts = df.select(column(id).alias("id"), body.alias("body"), spoken.alias("language"))
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).alias("fold")
    labelled = written(texts.join(F.broadcast(sample), "id").select("*", fold), folder, "labelled")
    words = choose_vocabularies(labelled, vocabulary, folder)
    sizes = {name: len(own) for name, own in words.items()}

    found = ", ".join(f"{name} array<int>" for name in words)
    marked = labelled.mapInArrow(_presence(words), extended(labelled.drop("body"), found))
    training = with_targets(written(marked, folder, "marked"))
    for apart in range(FOLDS if CATEGORIES else 0):
        training = with_targets(training, apart)
    models = fit_chain(written(training.drop("language"), folder, "training"), sizes, folder)

    marked_schema = extended(source.select("id"), "found array<int>")
    scored, earlier = source.mapInArrow(_presence({"found": words["found"]}), marked_schema), []
    for category in CHAIN:
        scored = scored.withColumn(f"p_{category}", _probability(models[category], earlier))
        earlier.append(category)
    score = F.col(f"p_{CHAIN[-1]}")
    return scored.select(
        "id", *(f"p_{c}" for c in CATEGORIES), score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"), (score >= THRESHOLD).alias("toxic"),
    )
