"""Delivery time, lateness and what it does to reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import percent_2dp
from tradewind.operators.star import Star
from tradewind.plans.common import late_share, mean_where, n_rows, weighted_mean

# Upper limits in days and labels of the delivery buckets.
DELIVERY_BUCKETS = (
    (3, "0-3 days"),
    (7, "4-7 days"),
    (14, "8-14 days"),
    (30, "15-30 days"),
    (None, "30+ days"),
)


def bucket(days: Column, buckets: tuple[tuple[int | None, str], ...]) -> Column:
    """Label of the first bucket whose limit is not exceeded; the last one is open."""
    *limited, (_, rest) = buckets
    labels = [F.when(days <= limit, label) for limit, label in limited]
    return F.coalesce(*labels, F.lit(rest))


def delivery_summary(star: Star) -> DataFrame:
    """One row over orders with status delivered."""
    late = F.col("is_late_delivery")
    return (
        star.dims["dim_order"]
        .where(F.col("order_status") == "delivered")
        .agg(
            F.count("order_delivered_customer_date").alias("delivered_orders"),
            mean_where("delivery_days").alias("avg_delivery_days"),
            mean_where("estimated_delivery_days").alias("avg_estimated_days"),
            late_share().alias("late_delivery_pct"),
            mean_where("delay_days", late).alias("avg_delay_when_late"),
        )
    )


def late_by_state(star: Star, min_orders: int = 100) -> DataFrame:
    """Delivered orders, line-weighted delivery days and lateness per customer state."""
    return (
        star.orders.where("is_delivered")
        .groupBy("customer_state")
        .agg(
            n_rows().alias("delivered_orders"),
            weighted_mean("delivery_days").alias("avg_delivery_days"),
            late_share("line_count").alias("late_pct"),
        )
        .where(F.col("delivered_orders") >= min_orders)
        .orderBy(F.desc("late_pct"), "customer_state")
    )


def _reviewed_deliveries(star: Star, label: str) -> DataFrame:
    """Orders with known lateness and a review, labelled late or not.

    The order frame holds both for every order, so this is a scan.
    """
    known = F.col("is_late_delivery").isNotNull() & F.col("review_sk").isNotNull()
    flag = F.when(F.col("is_late_delivery"), "Late").otherwise("On Time")
    return star.frame.where(known).select(flag.alias(label), "review_score")


def late_vs_reviews(star: Star, low_score: int = 2) -> DataFrame:
    low = F.col("review_score") <= low_score
    return (
        _reviewed_deliveries(star, "delivery_flag")
        .groupBy("delivery_flag")
        .agg(
            n_rows().alias("review_rows"),
            mean_where("review_score").alias("avg_score"),
            percent_2dp(F.count_if(low), n_rows()).alias("pct_low_scores"),
        )
    )


def demo_late_ratings(star: Star) -> DataFrame:
    return (
        _reviewed_deliveries(star, "status")
        .groupBy("status")
        .agg(mean_where("review_score").alias("avg_score"), n_rows().alias("n"))
    )


def delivery_buckets(star: Star, buckets=DELIVERY_BUCKETS) -> DataFrame:
    """Orders and share per delivery-time bucket, fastest first."""
    label = bucket(F.col("delivery_days"), buckets)
    grouped = (
        star.dims["dim_order"]
        .where(F.col("delivery_days").isNotNull())
        .groupBy(label.alias("delivery_bucket"))
        .agg(n_rows().alias("orders"), F.min("delivery_days").alias("_fastest"))
    )
    # One row per bucket from here on.
    share = percent_2dp(F.col("orders"), F.sum("orders").over(Window.partitionBy()))
    return grouped.withColumn("pct", share).orderBy("_fastest").drop("_fastest")


def kpi_on_time(star: Star) -> DataFrame:
    known = star.dims["dim_order"].where(F.col("is_late_delivery").isNotNull())
    on_time = percent_2dp(F.count_if(~F.col("is_late_delivery")), n_rows())
    return known.agg(on_time.alias("on_time_delivery_pct"))
