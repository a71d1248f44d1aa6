"""Layers behind the queries: stored when read, and without dealing all rows out again."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oracles import queries
from tradewind.session import scratch_root

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")


@pytest.fixture()
def layers(spark):
    """A fresh set of layers, and the tables it has stored so far as layer/table."""
    root = Path(scratch_root(spark).removeprefix("file:")) / "tradewind" / spark.sparkContext.applicationId
    before = set(root.glob("*"))

    def stored():
        new = (p for p in root.glob("*/*") if p.parent not in before)
        return {f"{p.parent.name.rsplit('-', 1)[0]}/{p.name}" for p in new}

    return queries.Inputs(spark, SF_DIR), stored


@pytest.mark.parametrize(
    ("query", "wanted"),
    [
        ("clean_leads", {"raw/qualified_leads"}),
        ("clean_geolocation", {"raw/geolocation"}),
        ("clean_deals", {"raw/closed_deals", "raw/qualified_leads", "cleaned/qualified_leads"}),
        ("build_dim_product", {"clean/products", "clean/category_translation"}),
    ],
)
def test_a_query_stores_only_the_tables_it_reads(layers, query, wanted):
    x, stored = layers
    queries.OPERATORS[query](x).count()
    assert stored() == wanted


def test_a_clean_check_stores_only_the_tables_it_reads(layers):
    x, stored = layers
    queries._metric("dq_origin_share")(x).count()
    assert stored() == {"clean/qualified_leads"}


def test_raw_files_follow_the_input(layers):
    """The number of files comes from the scan, not from the number of cores."""
    x, _ = layers
    raw = x.raw()["orders"]
    files = raw.select(F.input_file_name().alias("f")).distinct().count()
    assert files == 1 and raw.count() == x.role("w_orders").count()
