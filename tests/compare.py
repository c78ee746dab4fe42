"""Runs a registered query in Spark and its SQL in DuckDB and compares all rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


# Types that hold the same values in both engines.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN",
}


def type_differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    wanted = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name} is {kind}, not {wanted.get(name)}"
        for name, kind in df.dtypes
        if SAME_TYPE.get(kind) != wanted.get(name)
    ]


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both have the same columns, value types and rows in any order."""
    result = connection.execute(sql)
    expected_names = [c[0] for c in result.description]
    expected = result.fetchall()
    names = df.columns
    if sorted(names) != sorted(expected_names):
        return [f"columns {sorted(names)} instead of {sorted(expected_names)}"]
    order = [expected_names.index(n) for n in names]
    wanted = Counter(tuple(row[i] for i in order) for row in expected)
    found = Counter(tuple(row) for row in df.collect())
    if wanted == found:
        return type_differences(df, connection, sql)
    extra, lost = found - wanted, wanted - found
    return [
        f"{sum(found.values())} rows instead of {sum(wanted.values())}",
        f"columns {names}",
        f"only in Spark: {sum(extra.values())}, e.g. {list(extra)[:3]}",
        f"only in SQL: {sum(lost.values())}, e.g. {list(lost)[:3]}",
    ]
