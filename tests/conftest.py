from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradewind.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = open_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir="/tmp/tradewind-tests-warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """rows("a string, b int", [(..), ..]) -> DataFrame"""
    return lambda schema, data: spark.createDataFrame(data, schema)
