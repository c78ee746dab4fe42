from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from punctua.session import build_session

    session = build_session(
        "punctua-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    from punctua.session import clear_shared_folders

    clear_shared_folders(session)
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    import compare

    connection = compare.oracle(SF_DIR)
    yield connection
    connection.close()


@pytest.fixture
def rows(spark):
    """Builds a DataFrame from a schema text and plain tuples."""

    def build(schema: str, data: list[tuple]):
        return spark.createDataFrame(data, schema)

    return build
