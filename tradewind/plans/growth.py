"""New and returning customers, cohorts, repeat purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import month_index, month_start, percent_2dp
from tradewind.operators.star import Star
from tradewind.plans.common import n_rows
from tradewind.plans.customer import PERSON


def _person_months(star: Star) -> DataFrame:
    """One row per customer and month with orders: number of orders, first month.

    Everything about cohorts is month-granular, so orders are first reduced to this on
    the map side.  After it a customer owns at most one row per calendar month, so the
    window holding a customer's rows stays small however many orders they placed.
    """
    months = star.orders.groupBy(PERSON, month_start(F.col("purchase_date")).alias("month")).agg(
        n_rows().alias("orders")
    )
    first = F.min("month").over(Window.partitionBy(PERSON))
    return months.withColumn("cohort_month", first)


def new_vs_returning(star: Star) -> DataFrame:
    """Orders per month by customers in their first month and in later ones."""
    orders, new = F.col("orders"), F.col("month") == F.col("cohort_month")
    return (
        _person_months(star)
        .groupBy(F.col("month").alias("order_month"))
        .agg(
            F.sum(F.when(new, orders).otherwise(0)).alias("new_customer_orders"),
            F.sum(F.when(~new, orders).otherwise(0)).alias("returning_customer_orders"),
            F.sum(orders).alias("total_orders"),
        )
        .orderBy("order_month")
    )


def cohort_retention(star: Star, last_month: int = 6) -> DataFrame:
    """Share of each first-purchase cohort that buys again in months 0 to `last_month`.

    Month 0 holds every member, so it gives the cohort sizes as well; the window reading it
    off sees one row per month of a cohort.
    """
    elapsed = month_index(F.col("month")) - month_index(F.col("cohort_month"))
    active = (
        _person_months(star)
        .groupBy("cohort_month", elapsed.alias("month_number"))
        .agg(n_rows().alias("active_customers"))
    )
    in_month_0 = F.when(F.col("month_number") == 0, F.col("active_customers"))
    size = F.max(in_month_0).over(Window.partitionBy("cohort_month"))
    return (
        active.withColumn("cohort_customers", size)
        .where(F.col("month_number").between(0, last_month))
        .select(
            "cohort_month",
            "month_number",
            "cohort_customers",
            "active_customers",
            percent_2dp(F.col("active_customers"), F.col("cohort_customers")).alias(
                "retention_pct"
            ),
        )
        .orderBy("cohort_month", "month_number")
    )


def repeat_90d(star: Star, days: int = 90) -> DataFrame:
    """Customers with two or more orders, all within `days` of the first."""
    people = star.orders.groupBy(PERSON).agg(
        n_rows().alias("orders"),
        F.datediff(F.max("purchase_date"), F.min("purchase_date")).alias("span"),
    )
    repeat = (F.col("orders") >= 2) & (F.col("span") <= days)
    return people.agg(F.count_if(repeat).alias("customers_with_90d_repeat"))
