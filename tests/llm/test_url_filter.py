from __future__ import annotations

import compare
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from punctua.llm import queries
from punctua.llm.url_filter import judge_urls


def plain(urls, rules, default="allow"):
    out = []
    known = {}
    for host, path, verdict in rules:
        if host is not None:
            key = (host.lower(), path or "")
            known[key] = max(known.get(key, ""), verdict)
    for url in urls:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host, rest = rest[:cut].lower(), rest[cut:]
            path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
        fits = [
            (len(h + p), len(h), h + p, v)
            for (h, p), v in known.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, 0, None, default))
        out.append((url, host, path, best[2], best[3]))
    return sorted(out, key=str)


def judged(rows, urls, rules):
    df = rows("url string", [(u,) for u in urls])
    found = judge_urls(df, rows("host string, path string, verdict string", rules))
    return sorted((tuple(r) for r in found.select("url", "host", "path", "rule", "verdict").collect()), key=str)


def test_query_against_sql(spark, oracle):
    df = queries.op2_url_filter(spark, SF_DIR)
    assert compare.differences(df, oracle, queries.SQL["op2_url_filter"]) == []


def test_no_python_in_the_plan(spark):
    plan = queries.op2_url_filter(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


URLS = [
    None, "", "no scheme", "http://", "http://net", "HTTP://A.NET/x", "http://net./", "http://xnet/",
    "http://a.b.example.net/en/1?q=/de/#f", "http://example.net/en", "http://example.net/en/",
    "http://example.net:80/en/", "http://example.com?/de/", "http://example.com/de/é",
    "http://example.com/de/é", "x://y://example.org/fr/", "http://ünet/", "http://.net/",
]
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"), ("a.net", "/", "allow"), ("net", "/x/", "block"), (None, "/", "block"),
    ("com", None, "allow"), ("com", None, "block"), ("", "", "block"),
]


def test_edges(rows):
    assert judged(rows, URLS, RULES) == plain(URLS, RULES)


def test_empty_tables(rows):
    assert judged(rows, [], RULES) == []
    assert judged(rows, URLS, []) == plain(URLS, [])


def test_extra_columns_stay(rows):
    df = rows("key int, point string, host string, url string", [(1, "p", "old", "http://a.net/")])
    rules = rows("host string, path string, verdict string, key int", [("net", "/", "block", 3)])
    found = judge_urls(df, rules).first().asDict()
    assert found == {"key": 1, "point": "p", "url": "http://a.net/", "host": "a.net", "path": "/",
                     "rule": "net/", "verdict": "block"}


hosts = st.lists(st.sampled_from(["a", "b", "net", ""]), max_size=4).map(".".join)
paths = st.lists(st.sampled_from(["/", "/a", "b", "/é"]), max_size=3).map("".join)


@pytest.mark.parametrize("parts", [1, 5])
@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(hosts, paths).map(lambda x: f"s://{x[0]}{x[1]}"), max_size=30),
    st.lists(st.tuples(hosts, paths, st.sampled_from(["allow", "block"])), max_size=12),
)
def test_random_rules(parts, urls, rules):
    """Also over several range partitions, where open intervals are inherited."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        def rows(schema, data):
            return spark.createDataFrame(data, schema)

        rules = [r for r in rules if "/" not in r[0]]
        assert judged(rows, urls, rules) == plain(urls, rules)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
