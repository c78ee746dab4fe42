"""Every registered query against its SQL, all rows and columns."""

from __future__ import annotations

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from workload import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, name):
    query = QUERIES[name]
    df = query.build(spark, SF_DIR)
    if query.sql is None:
        assert df.count() > 0
        return
    assert compare.differences(df, oracle, query.sql) == []


def test_contract(spark):
    assert contract.queries().keys() >= contract.oracle_sql().keys()
    flagship = contract.entry(spark)
    assert flagship.columns == ["day", "bundle", "percent_rt"]
    assert flagship.count() > 0


def test_every_inventory_item_is_registered():
    wanted = {f"S{n}" for n in range(1, 19)} | {f"P{n}" for n in range(1, 23)}
    wanted |= {f"J{n}" for n in range(1, 10)} | {f"A{n}" for n in range(1, 27)}
    wanted |= {f"C{n}" for n in range(1, 28)}
    wanted |= {"W1", "W2", "O1", "O2", "O3", "O4", "U1"}
    # listing names and columns reads no rows: tested, not registered
    wanted -= {"S11"}
    covered = {i for q in QUERIES.values() for i in q.ids}
    assert sorted(wanted - covered) == []
