"""Revenue over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import from_cents, mean_cents, month_start
from tradewind.operators.star import Star
from tradewind.plans.common import LOST_STATUSES, growth, money, n_rows, sold


def monthly_gmv(star: Star, excluded: tuple[str, ...] = LOST_STATUSES) -> DataFrame:
    """Per month: orders, lines, GMV, freight, contribution, running GMV, growth."""
    monthly = (
        sold(star.orders, excluded)
        .groupBy(month_start(F.col("purchase_date")).alias("month"))
        .agg(
            n_rows().alias("orders"),
            F.sum("line_count").alias("items_sold"),
            F.sum("revenue_cents").alias("gmv_cents"),
            F.sum("freight_cents").alias("freight_cents"),
        )
    )
    # One row per month from here on.
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    contribution = F.col("gmv_cents") - F.col("freight_cents")
    return monthly.select(
        F.year("month").alias("year_number"),
        F.month("month").alias("month_number"),
        F.date_format("month", "MMM").alias("month_name"),
        "orders",
        "items_sold",
        *money(gmv="gmv_cents", freight_cost="freight_cents"),
        from_cents(contribution).alias("contribution"),
        from_cents(F.sum("gmv_cents").over(so_far)).alias("running_gmv"),
        growth("gmv_cents", ["month"]).alias("mom_gmv_growth_pct"),
    ).orderBy("year_number", "month_number")


def yearly_gmv(star: Star) -> DataFrame:
    """Per year over all statuses: GMV, orders, last year's GMV, growth."""
    yearly = star.orders.groupBy(F.year("purchase_date").alias("year_number")).agg(
        F.sum("revenue_cents").alias("gmv_cents"), n_rows().alias("orders")
    )
    prior = F.lag("gmv_cents").over(Window.orderBy("year_number"))
    return yearly.select(
        "year_number",
        *money(gmv="gmv_cents"),
        "orders",
        from_cents(prior).alias("prior_year_gmv"),
        growth("gmv_cents", ["year_number"]).alias("yoy_growth_pct"),
    ).orderBy("year_number")


def demo_monthly_mom(star: Star) -> DataFrame:
    """Per month over all statuses: GMV and growth."""
    monthly = star.orders.groupBy(month_start(F.col("purchase_date")).alias("month")).agg(
        F.sum("revenue_cents").alias("gmv_cents")
    )
    return monthly.select(
        "month", *money(gmv="gmv_cents"), growth("gmv_cents", ["month"]).alias("mom_pct")
    ).orderBy("month")


def rolling_7d(star: Star, rows: int = 7) -> DataFrame:
    """Per day with sales: orders and GMV, and both over the last `rows` such days."""
    daily = star.orders.groupBy(F.col("purchase_date").alias("full_date")).agg(
        n_rows().alias("daily_orders"), F.sum("revenue_cents").alias("gmv_cents")
    )
    # One row per day: an un-partitioned window over a few thousand rows.
    recent = Window.orderBy("full_date").rowsBetween(1 - rows, Window.currentRow)
    return daily.select(
        "full_date",
        "daily_orders",
        *money(daily_gmv="gmv_cents"),
        F.sum("daily_orders").over(recent).alias("orders_7d_rolling"),
        mean_cents(F.sum("gmv_cents").over(recent), n_rows().over(recent)).alias("gmv_7d_avg"),
    ).orderBy("full_date")
