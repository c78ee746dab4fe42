from __future__ import annotations

import time

import compare
import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctua.llm import queries
from punctua.llm.periodic_runs import (
    COVER,
    RESIDUES,
    STEPS,
    Extensions,
    periodic_runs,
    planted,
    runs_of_texts,
    strongest,
)


def plain_runs(words, least=6, times=4):
    """Every period at every place; of one stretch the smallest period."""
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            first = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - first + q
            if i > first and length >= max(least, times * q):
                out.setdefault((first, length), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_any_two_places_reach_samples_by_one_step():
    for a in range(COVER):
        for b in range(COVER):
            assert {(a + STEPS[a, b]) % COVER, (b + STEPS[a, b]) % COVER} <= set(RESIDUES)


@given(st.lists(st.integers(0, 2), min_size=1, max_size=120), st.data())
@settings(max_examples=60, deadline=None)
def test_extensions_equal_counting(numbers, data):
    numbers = np.array([*numbers * 2, 9])
    extension = Extensions(numbers)
    i = data.draw(st.integers(0, len(numbers) - 2))
    j = data.draw(st.integers(i + 1, len(numbers) - 1))
    same = 0
    while j + same < len(numbers) and numbers[i + same] == numbers[j + same]:
        same += 1
    assert extension(np.array([i]), np.array([j])).tolist() == [same]


words = st.lists(st.sampled_from("ab"), max_size=60) | st.tuples(
    st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), min_size=1, max_size=7),
    st.integers(1, 30), st.lists(st.sampled_from("abc"), max_size=9),
).map(lambda t: t[0] + t[1] * t[2] + t[3])


@given(st.lists(words, max_size=6), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
@settings(max_examples=150, deadline=None)
def test_runs_of_several_texts_equal_brute_force(docs, law):
    bodies = [" ".join(d).encode() for d in docs]
    for own, (n, runs, rest) in zip(docs, runs_of_texts(bodies, *law), strict=True):
        wanted = plain_runs(own, *law)
        assert n == len(own)
        assert [tuple(r) for r in runs.tolist()] == sorted(wanted, key=lambda r: (r[0], r[2]))
        assert rest.decode() == collapsed(own, wanted)


def test_nulls_empty_texts_repeated_rows_and_clashing_names(rows):
    data = [(1, None, "x", 1), (2, "", "x", 2), (None, "a b " * 4, "x", 3), (None, "a b " * 4, "x", 3),
            (5, "  \x1c \t\n", "x", 4)]
    df = rows("doc_id long, text string, runs string, body long", data)
    found = periodic_runs(df)
    assert found.columns == ["doc_id", "text", "body", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (5, 2, [], "  \x1c")] + [(None, 8, [(0, 8, 2)], "a b")] * 2, key=str
    )
    assert periodic_runs(df.limit(0)).count() == 0


def test_strongest_run_is_exact_and_the_first_of_equals(rows):
    df = rows("runs array<struct<start:long,length:long,period:long>>",
              [([(0, 9, 2), (5, 12, 3), (20, 18, 4), (40, 9, 2)],), ([],)])
    found = [r.best for r in df.select(strongest(F.col("runs")).alias("best")).collect()]
    assert [tuple(found[0]), found[1]] == [(0, 9, 2), None]


def test_very_long_texts_of_one_word_and_of_two(rows):
    began = time.process_time()
    ((n, runs, rest),) = runs_of_texts([b"a " * 300_000], 6, 4)
    assert (n, runs.tolist(), rest) == (300_000, [[0, 300_000, 1]], b"a")
    df = rows("text string", [("a b c " * 100_000,)])
    (row,) = periodic_runs(df, keep=[]).collect()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 3)]
    assert row.collapsed == "a b c"
    assert time.process_time() - began < 20


def test_planted_texts_follow_the_rule(spark):
    import zlib

    text = " ".join(map(str, range(50)))
    df = spark.range(200).select("id", planted(F.lit(text), F.col("id")).alias("text"))
    for r in df.collect():
        h = zlib.crc32(str(r.id).encode())
        own = text.split()
        if h % 10 == 0:
            g = h // 10
            a = g % 50
            p = 1 + (50 - a) // (3 + g % 8)
            own = [own[a + (i - a) % p] if i >= a else w for i, w in enumerate(own)]
        assert r.text == " ".join(own)


def test_periods_of_less_than_two_repeats_are_refused(rows):
    with pytest.raises(ValueError):
        periodic_runs(rows("text string", []), times=1)


def test_query_equals_its_sql(spark, oracle):
    df = queries.op11_periodic_runs(spark, SF_DIR)
    assert compare.differences(df, oracle, queries.OP11_SQL) == []
