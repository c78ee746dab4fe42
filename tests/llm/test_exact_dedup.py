from __future__ import annotations

import compare
from conftest import SF_DIR

from punctua.llm import exact_dedup, queries
from punctua.llm.exact_dedup import exact_duplicates
from punctua.llm.rows import written
from punctua.session import CLEANUP


def test_query_against_sql(spark, oracle):
    df = queries.op8_exact_dedup(spark, SF_DIR)
    assert compare.differences(df, oracle, queries.SQL["op8_exact_dedup"]) == []


def result(df):
    out = exact_duplicates(df).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out), key=str)


def test_same_length_same_beginning_same_text(rows):
    start = "s" * exact_dedup.PREFIX
    data = [(1, start + "ab"), (2, start + "ba"), (3, start + "ab"), (4, "q" + start), (5, "r" + start)]
    df = rows("doc_id int, text string", data)
    assert result(df) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 1, True)]


def test_nulls_ties_long_and_clashing_columns(rows):
    long = "é" * 200_000
    data = [(1, None), (2, ""), (None, ""), (7, long), (7, long), (8, "x"), (8, "y"), (None, "z"), (None, "z")]
    df = rows("doc_id int, text string", data)
    df = df.withColumns({"id": df.text, "row": df.doc_id, "full": df.text, "tag": df.text, "kept": df.text})
    out = exact_duplicates(df).collect()
    assert len(out) == len(data)
    stays = sorted(((r.doc_id, r.text and r.text[:1]) for r in out if r.kept), key=str)
    assert stays == sorted([(2, ""), (7, "é"), (8, "x"), (8, "y"), (None, "z")], key=str)
    assert {r.keep_id for r in out if not r.text} == {2}
    assert sorted(r.group_size for r in out) == [1, 1, 2, 2, 2, 2, 3, 3, 3]


def test_empty_table(rows):
    assert result(rows("doc_id int, text string", [])) == []


def test_full_bitmap_changes_nothing(rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BITS", 64)
    monkeypatch.setattr(exact_dedup, "MOST_BITS", 64)
    data = [(i, f"text {i % 150}") for i in range(400)]
    got = result(rows("doc_id int, text string", data))
    last = {i % 150: i for i in range(400)}
    assert [g[1] for g in sorted(got)] == [last[i % 150] for i in range(400)]


def test_full_hashes_stay_in_proportion_to_the_groups(rows, monkeypatch):
    """With more groups than the smallest map has bits, rows without a twin are still let off."""
    hashed = []

    def counted(df, folder, name):
        out = written(df, folder, name)
        if name == "hashed":
            hashed.append(out.filter("full IS NOT NULL").count())
        return out

    monkeypatch.setattr(exact_dedup, "BITS", 64)
    monkeypatch.setattr(exact_dedup, "written", counted)
    data = [(i, f"twin {i % 300}") for i in range(600)] + [(1000 + i, f"alone {i} {'x' * i}") for i in range(900)]
    got = result(rows("doc_id int, text string", data))
    assert sum(not g[3] for g in got) == 300
    assert 600 <= hashed[0] < 600 + 0.2 * 900


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    out = written(spark.range(1000).repartition(4).groupBy("id").count(), str(tmp_path), "table")
    assert not shuffle_files(spark) - before
    assert out.count() == 1000
    assert spark.conf.get(CLEANUP) == "false"


def test_rows_without_a_twin_are_not_written(rows, monkeypatch):
    sizes = {}

    def counted(df, folder, name):
        out = written(df, folder, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(exact_dedup, "written", counted)
    data = [(i, f"text {max(i, 5)}") for i in range(500)]
    got = result(rows("doc_id int, text string", data))
    assert [g[3] for g in sorted(got)] == [False] * 5 + [True] * 495
    assert 6 <= sizes["hashed"] < 30
