"""Executive snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import from_cents
from tradewind.operators.quality import count_of
from tradewind.operators.star import Star
from tradewind.plans.common import LOST_STATUSES, n_rows, sold, weighted_mean


def kpi_snapshot(star: Star, excluded: tuple[str, ...] = LOST_STATUSES) -> DataFrame:
    """Orders, customers, sellers, GMV, contribution and line-weighted review score.

    Three distinct counts in one aggregation would copy every line three times.  Orders
    are the rows of the order book; customers and sellers are counted by aggregations of
    their own that keep one row per key and map task.
    """
    orders = sold(star.orders, excluded)
    people = orders.select("customer_unique_id").distinct()
    sellers = sold(star.lines, excluded).select("seller_sk").distinct()
    return orders.agg(
        n_rows().alias("total_orders"),
        F.sum("revenue_cents").alias("gmv"),
        F.sum("freight_cents").alias("freight"),
        weighted_mean("review_score").alias("avg_review_score"),
    ).select(
        "total_orders",
        count_of(people.where("customer_unique_id is not null")).scalar().alias(
            "unique_customers"
        ),
        count_of(sellers).scalar().alias("active_sellers"),
        from_cents(F.col("gmv")).alias("total_gmv"),
        from_cents(F.col("gmv") - F.col("freight")).alias("total_contribution"),
        "avg_review_score",
    )
