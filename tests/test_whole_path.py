"""From dirty text to metrics: no line may vanish without a trace."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.market import RAW, raw_frames
from tradewind.operators.cleaning import clean_all
from tradewind.operators.integrity import require_constraints
from tradewind.operators.star import build_star, require_all_lines
from tradewind.plans.customer import payment_mix
from tradewind.plans.delivery import late_vs_reviews
from tradewind.plans.revenue import yearly_gmv
from tradewind.sources.contracts import CLEAN_TABLES

WHEN = "2020-01-05 10:00:00"
MORE = {
    "customers": [("k1", "p1", "1", "x", "sp"), ("k2", "p2", "x9", "x", "sp")],
    # k2 is refused for its zip, k3 never existed.
    "orders": [
        (f"q{i}", f"k{i}", "delivered", WHEN, "", "", "", "") for i in (1, 2, 3)
    ] + [("q4", "k1", "delivered", WHEN, "2018", "", "", ""),
         ("q5", "k1", "delivered", "2018-02", "", "", "", "")],
    "order_items": [(f"q{i}", "1", "p1", "s1", "", "10.00", "1") for i in range(1, 6)],
    "order_payments": [(f"q{i}", "1", "slip", "-3" if i == 1 else "1", "10") for i in (1, 2)],
    "qualified_leads": [
        (f"x{i}", text, "l", "paid")
        for i, text in enumerate(("2018-01-01 garbage", "2018", "2018-02", "2018-1-2T??", "2018-1-2", "2018-01-02 03:04"))
    ],
}


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = raw_frames(spark)
    for name, rows in MORE.items():
        raw[name] = raw[name].unionByName(spark.createDataFrame(rows, raw[name].schema))
    return clean_all(raw)


@pytest.fixture(scope="module")
def star(spark, cleaned, tmp_path_factory):
    return build_star(spark, cleaned[0], str(tmp_path_factory.mktemp("star")))


def test_lost_lines_are_in_the_quarantine(cleaned, star):
    got = Counter((r.table_name, r.reason) for r in cleaned[1].collect())
    assert got["orders", "orphan_customers"] == 2
    assert got["orders", "malformed_order_approved_at"] == 1
    assert got["orders", "malformed_order_purchase_timestamp"] == 2
    # q2 and q3 by their customers, q4 and q5 by their dates, "zz" as before.
    assert got["order_items", "orphan_orders"] == 5
    assert got["order_payments", "orphan_orders"] == 2
    assert got["order_payments", "out_of_domain_payment_installments"] == 1
    n_items = len(RAW["order_items"][1]) + len(MORE["order_items"])
    kept = cleaned[0]["order_items"].count()
    assert kept + sum(n for (t, _), n in got.items() if t == "order_items") == n_items
    assert star.lines.count() == kept == 7
    require_all_lines(star)
    total = sum(r.gmv for r in yearly_gmv(star).collect())
    assert total == Decimal("390.01")


def test_dates_are_taken_whole_or_not_at_all(cleaned):
    leads = {r.mql_id: str(r.first_contact_date) for r in cleaned[0]["qualified_leads"].collect()}
    assert {k: v for k, v in leads.items() if k[0] == "x"} == {"x4": "2018-01-02", "x5": "2018-01-02"}
    refused = Counter(r.reason for r in cleaned[1].where("table_name = 'qualified_leads'").collect())
    assert refused["malformed_first_contact_date"] == 5


def test_gate_stops_broken_layers_and_lost_lines(cleaned, star):
    clean = cleaned[0]
    require_constraints(clean, CLEAN_TABLES)
    with pytest.raises(ValueError, match="references: orders customers"):
        require_constraints({**clean, "customers": clean["customers"].limit(1)}, CLEAN_TABLES)
    negative = clean["order_payments"].withColumn("payment_installments", F.lit(-1))
    with pytest.raises(ValueError, match="conditions: order_payments"):
        require_constraints({**clean, "order_payments": negative}, CLEAN_TABLES)
    with pytest.raises(ValueError, match="clean lines gave"):
        require_all_lines(replace(star, lines=star.lines.limit(2)))


def test_review_and_payment_metrics_join_nothing(star):
    for plan in (late_vs_reviews(star), payment_mix(star)):
        assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
