from __future__ import annotations

import random

import brute
import compare
import pytest
from conftest import SF_DIR

from punctua.llm import queries
from punctua.llm.decontaminate import contamination, decontaminated


def got(df, items, **options):
    return [
        (r.id, r.n_words, r.n_hit, r["items"]) for r in contamination(df, items, **options).collect()
    ]


def wanted(docs, items, window):
    out = []
    for i, t in docs:
        n, listed = brute.contaminated_words(t, items, window)
        out.append((i, len(brute.bench_words(t)), n, listed))
    return out


def test_query_against_sql(spark, oracle):
    df = queries.op6_decontamination(spark, SF_DIR)
    assert compare.differences(df, oracle, queries.SQL["op6_decontamination"]) == []


@pytest.mark.parametrize("window", [1, 3, 10])
def test_random_texts(rows, window):
    """Few different words, so that windows overlap, repeat and nearly match."""
    rng = random.Random(window)

    def text(n):
        return " ".join(rng.choice(["a", "B", "b", "c1", "é", "the"]) for _ in range(n))

    items = [(i, text(rng.randrange(0, 14))) for i in range(6)]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(40)]
    docs += [(40 + i, text(5) + " " + t + " " + text(5)) for i, (_, t) in enumerate(items)]
    df = rows("doc_id int, text string", docs)
    bench = rows("item_id int, text string", items)
    assert sorted(got(df, bench, window=window)) == sorted(wanted(docs, items, window))


def test_nulls_repeats_long_and_clashing_columns(rows):
    passage = " ".join(f"p{i}" for i in range(30))
    long = "x " * 50_000 + passage + " y" * 50_000
    items = [(7, passage), (7, passage), (8, None), (9, "…!"), (None, "short one"), (10, "ab")]
    docs = [
        (1, None), (2, ""), (3, "…"), (4, long), (4, long), (5, "A short-one!"), (None, "p3"),
        (6, "p0, P1. p2 p3 p4 p5 p6 p7 p8 p9 ab"), (None, None),
    ]
    df = rows("doc_id bigint, text string", docs)
    bench = rows("item_id bigint, text string", items)
    key = lambda r: str(r)
    assert sorted(got(df, bench), key=key) == sorted(wanted(docs, items, 10), key=key)
    wide = df.withColumns({"n_hit": df.text, "row": df.doc_id, "print": df.doc_id, "id": df.text})
    out = decontaminated(wide, bench.withColumn("words", bench.text)).collect()
    assert len(out) == len(docs) and {r.n_hit for r in out if r.doc_id == 4} == {30}


def test_empty_tables(rows):
    df, bench = rows("doc_id int, text string", []), rows("item_id int, text string", [])
    assert got(df, rows("item_id int, text string", [(1, "a b")])) == []
    assert got(rows("doc_id int, text string", [(1, "a b")]), bench) == [(1, 2, 0, [])]
