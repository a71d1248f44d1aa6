"""What the metrics of the suite send through an exchange."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_scale import exchanged_rows, final_plan, star  # noqa: F401
from tradewind.operators import keys
from tradewind.operators.integrity import duplicate_keys, repeated_keys
from tradewind.plans.catalog import METRICS
from tradewind.sources.tables import materialize_table


def test_repeated_line_keys_are_found_alike_when_dealt_by_order(spark, monkeypatch):
    n = F.col("id")
    lines = spark.range(9_000, numPartitions=4).select(
        F.when(n % 3 == 0, "hot").when(n % 50 != 1, (n % 2000).cast("string")).alias("o"),
        F.when(n % 7 != 0, n % 4).alias("i"),
    )
    for hot_rows in (1 << 16, 100):
        monkeypatch.setattr(keys, "HOT_ROWS", hot_rows)
        got = repeated_keys(lines, ["o", "i"], deal_by=["o"]).collect()
        assert sorted(map(str, got)) == sorted(map(str, duplicate_keys(lines, ["o", "i"]).collect()))


def test_pairs_of_seller_and_category_cross_once(star):  # noqa: F811
    plan = final_plan(METRICS["sellers_above_category_avg"].run(star))
    assert "ReusedExchange" in plan


class Sold:
    """A seller book and what the funnel metrics read beside it."""

    def __init__(self, spark, tmp_path):
        self.sellers = materialize_table(
            spark.range(40_000, numPartitions=4).select(
                (F.col("id") % 400).alias("seller_sk"),
                (F.col("id") % 9_000).alias("order_sk"),
                (F.col("id") % 3 + 1).alias("line_count"),
                (F.col("id") % 700).alias("price_cents"),
                (F.col("id") % 5 != 0).alias("is_delivered"),
                F.when(F.col("id") % 11 != 0, (F.col("id") % 30).cast("int")).alias("delivery_days"),
                F.when(F.col("id") % 13 != 0, F.col("id") % 4 == 0).alias("is_late_delivery"),
                F.when(F.col("id") % 6 != 0, (F.col("id") % 5 + 1).cast("smallint")).alias("review_score"),
            ),
            str(tmp_path / "sellers"),
        )
        self.dims = {
            "dim_seller": spark.range(400).select(
                F.col("id").cast("string").alias("seller_id"), F.col("id").alias("seller_sk")
            )
        }
        deals = [
            ("a", "1", "shop"), ("b", "1", "shop"), ("c", "1", None), ("d", "7", "shop"),
            ("e", "7", "web"), ("f", "8", None), ("g", None, "web"), ("h", "999", "web"),
        ]
        won = spark.createDataFrame(deals, "mql_id string, seller_id string, business_type string")
        leads = won.select("mql_id").withColumn("origin", F.when(F.col("mql_id") < "d", "x"))
        day = F.lit("2020-01-01").cast("date").alias("first_contact_date")
        self.clean = {"closed_deals": won, "qualified_leads": leads.select("*", day)}


@pytest.fixture()
def few_small_joins(spark):
    """The seller book is too large to broadcast, the deals are not."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "20000")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["acquired_seller_gmv", "acquired_delivery_quality"])
def test_the_seller_book_meets_few_deals_without_an_exchange(spark, tmp_path, few_small_joins, name):
    assert exchanged_rows(METRICS[name].run(Sold(spark, tmp_path))) < 5_000


def test_delivery_quality_counts_a_seller_once_per_deal(spark, tmp_path):
    """As lines joined with every single deal, which is what folded deals stand for."""
    star = Sold(spark, tmp_path)  # noqa: F811
    deals = star.clean["closed_deals"].join(star.dims["dim_seller"], "seller_id")
    lines = (
        star.sellers.where("is_delivered")
        .join(deals.select("seller_sk", F.coalesce("business_type", F.lit("unknown")).alias("kind")), "seller_sk")
        .withColumn("line", F.explode(F.sequence(F.lit(1), "line_count")))
    )
    wanted = lines.groupBy("kind").agg(
        F.count_distinct("order_sk").alias("orders"),
        F.avg("delivery_days").alias("days"),
        (F.count_if("is_late_delivery") * 100 / F.count(F.lit(1))).alias("late"),
        F.avg("review_score").alias("review"),
    )
    got = METRICS["acquired_delivery_quality"].run(star, min_orders=1).collect()
    plain = {r.kind: r for r in wanted.collect()}
    assert {r.business_type for r in got} == set(plain) == {"shop", "web", "unknown"}
    for r in got:
        w = plain[r.business_type]
        assert r.orders == w.orders
        for a, b in ((r.avg_delivery_days, w.days), (r.late_pct, w.late), (r.avg_review, w.review)):
            assert abs(float(a) - b) <= 0.0051
