"""Every query against its SQL on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from oracles import queries, sql
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")

# The marketplace queries; those for training data have tests of their own.
QUERIES = queries.queries()
SQL = sql.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 113
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    same, note = compare(spark, duck, SF_DIR, name, QUERIES[name], SQL[name])
    assert same, note


def test_entry_is_lazy_and_typed(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["year_number", "month_number", "month_name"]
    assert df.count() > 0


def test_role_row_counts(spark):
    """Row counts of the roles on the mid-sized tables are the documented ones."""
    from oracles.queries import inputs

    x = inputs(spark, "/root/testdata/sf0.01")
    want = {
        "r_orders": 15_000,
        "r_items": 60_000,
        "r_payments": 29_663,
        "r_reviews_all": 13_636,
        "r_products": 2_000,
        "r_translation": 23,
        "r_leads": 2_017,
        "r_deals": 215,
    }
    assert {n: x.role(n).count() for n in want} == want
