from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from math import comb

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from punctua.llm import queries, sharding


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    out = queries.op5_sharding(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    slots = defaultdict(list)
    for r in out:
        body = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(body) + 16, zlib.crc32(body))
        assert (r.law, r.grown_shard) == ("rows", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(40)]
    assert set(slots) <= set(range(40)) and max(sizes) - min(sizes) <= 1


def test_no_python_in_the_plan(spark):
    plan = queries.op5_sharding(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("total", "good", "drawn"), [(10, 4, 5), (60, 3, 40), (7, 7, 3), (9, 0, 4), (5, 2, 0)])
def test_hypergeometric_law(spark, total, good, drawn):
    n = 4000
    u = (F.col("id") + 0.5) / n  # all quantiles, so shares are exact to 1 / n
    k = sharding.hypergeometric(F.lit(total), F.lit(good), F.lit(drawn), u)
    got = Counter(r.k for r in spark.range(n).select(k.alias("k")).collect())
    for value in range(0, good + 1):
        want = comb(good, value) * comb(total - good, drawn - value) / comb(total, drawn) if value <= drawn else 0
        assert abs(got[value] / n - want) <= 1.5 / n


def test_large_numbers(spark):
    u = (F.col("id") + 0.5) / 200
    big = sharding.hypergeometric(F.lit(30_000_000_000), F.lit(750_000_000), F.lit(1_000_000), u)
    got = [r.k for r in spark.range(200).select(big.alias("k")).collect()]
    assert abs(sum(got) / 200 - 25_000) < 20 and 24_000 < min(got) < max(got) < 26_000


@pytest.mark.parametrize("counts", [[5], [0, 3], [7, 1, 12, 0, 30], [100] * 9])
def test_matrix_margins(rows, counts):
    df = rows("part int, n bigint", list(enumerate(counts)))
    matrix = {r.part: list(r.to) for r in sharding.communication_matrix(df, 4, 1).collect()}
    assert [sum(matrix[i]) for i in range(len(counts))] == counts
    columns = [sum(matrix[i][s] for i in matrix) for s in range(4)]
    assert max(columns) - min(columns) <= 1 and min(min(m) for m in matrix.values()) >= 0


def test_every_shard_is_equally_likely(rows):
    """Rows of each third land in each of 3 shards about as often, with either seed."""
    df = rows("id int", [(i,) for i in range(900)]).repartition(3, "id")
    for seed in (1, 2):
        seen = Counter((r.id % 3, r.shard) for r in sharding.shuffle_into_shards(df, 3, seed).collect())
        assert all(abs(n - 100) < 40 for n in seen.values()) and len(seen) == 9


def test_nulls_repeats_and_clashing_columns(rows):
    data = [(None, None), (1, "x"), (1, "x"), (2, "y" * 300_000)]
    df = rows("doc_id int, text string", data)
    df = df.withColumns({"shard": df.text, "part": df.doc_id, "rank": df.text, "row": df.text, "n": df.text})
    out = sharding.shuffle_into_shards(df, 2).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "1", "2", "None"]
    assert sorted((r.shard, r.slot) for r in out) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert sharding.shuffle_into_shards(rows("a int", []), 3).collect() == []
    assert sorted((r.shard, r.slot) for r in sharding.shuffle_into_shards(rows("a int", [(1,)]), 3).collect()) == [(0, 0)]


def test_several_buckets_in_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    out = sharding.shuffle_into_shards(spark.range(500), 4, 3).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(125)) for s in slots.values()) and len(slots) == 4
    assert sorted(r.id for r in out) == list(range(500))
