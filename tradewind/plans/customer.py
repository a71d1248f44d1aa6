"""Customer value, repetition and segments.  A customer is a person, who owns one or more
order-scoped customer ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import from_cents, mean_2dp, mean_cents, percent_2dp
from tradewind.operators.numbering import global_ntile
from tradewind.operators.star import Star
from tradewind.plans.common import money, n_rows

PERSON = "customer_unique_id"


def _repeat_pct() -> Column:
    return percent_2dp(F.count_if(F.col("orders") > 1), n_rows())


def repeat_vs_one_time(star: Star) -> DataFrame:
    """One-time against repeat customers: number, share, mean and total revenue."""
    people = star.orders.groupBy(PERSON).agg(
        n_rows().alias("orders"), F.sum("revenue_cents").alias("cents")
    )
    kind = F.when(F.col("orders") == 1, "one_time").otherwise("repeat")
    grouped = people.groupBy(kind.alias("customer_type")).agg(
        n_rows().alias("customers"), F.sum("cents").alias("total_cents")
    )
    # Two rows from here on.
    return grouped.select(
        "customer_type",
        "customers",
        percent_2dp(F.col("customers"), F.sum("customers").over(Window.partitionBy())).alias(
            "pct_customers"
        ),
        mean_cents(F.col("total_cents"), F.col("customers")).alias("avg_lifetime_revenue"),
        *money(total_revenue="total_cents"),
    )


def top_customers(star: Star, limit: int = 10) -> DataFrame:
    """Most valuable customers; someone buying from two states appears under each."""
    people = star.orders.groupBy(PERSON, "customer_state").agg(
        n_rows().alias("orders"),
        F.sum("revenue_cents").alias("cents"),
        F.sum("line_count").alias("lines"),
    )
    return (
        people.orderBy(F.desc("cents"), PERSON, "customer_state")
        .limit(limit)
        .select(
            PERSON,
            "customer_state",
            "orders",
            *money(lifetime_value="cents"),
            mean_cents(F.col("cents"), F.col("lines")).alias("avg_item_price"),
        )
    )


def customers_without_reviews(star: Star) -> DataFrame:
    """Customers with at least one bought line whose order has no review.

    The line book already carries the outcome of the review lookup, so the anti join is a
    filter on a missing review key.
    """
    unreviewed = star.orders.where(F.col("review_sk").isNull()).select(PERSON).distinct()
    return unreviewed.agg(n_rows().alias("customers_without_reviews"))


# Segment names of the recency/frequency/monetary scores.
def _segment() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "Promising")
        .when((r <= 2) & (f >= 3), "At Risk")
        .otherwise("Others")
    )


def rfm_scores(star: Star, recency_best_high: bool = False, tiles: int = 5) -> DataFrame:
    """Quintile scores per customer.

    By default the most recent buyers get recency score 1, as in the figures this
    reproduces; `recency_best_high` turns that round.  Ties go by customer id.
    """
    people = star.orders.groupBy(PERSON).agg(
        F.max("purchase_date").alias("last_purchase_date"),
        n_rows().alias("frequency"),
        F.sum("revenue_cents").alias("monetary_cents"),
    )
    recent = F.asc if recency_best_high else F.desc
    scored = global_ntile(people, [recent("last_purchase_date"), F.asc(PERSON)], tiles, "r_score")
    scored = global_ntile(scored, [F.asc("frequency"), F.asc(PERSON)], tiles, "f_score")
    return global_ntile(scored, [F.asc("monetary_cents"), F.asc(PERSON)], tiles, "m_score")


def rfm_segments(star: Star, recency_best_high: bool = False) -> DataFrame:
    """Customers and mean spend per segment."""
    grouped = (
        rfm_scores(star, recency_best_high)
        .groupBy(_segment().alias("segment"))
        .agg(n_rows().alias("customers"), F.sum("monetary_cents").alias("cents"))
    )
    return grouped.select(
        "segment",
        "customers",
        mean_cents(F.col("cents"), F.col("customers")).alias("avg_monetary"),
    ).orderBy(F.desc("customers"), "segment")


def kpi_repeat_rate(star: Star) -> DataFrame:
    people = star.orders.groupBy(PERSON).agg(n_rows().alias("orders"))
    return people.agg(_repeat_pct().alias("repeat_customer_pct"))


def repeat_by_state(star: Star, min_customers: int = 500) -> DataFrame:
    """Repeat rate of states with enough customers."""
    people = star.orders.groupBy("customer_state", PERSON).agg(n_rows().alias("orders"))
    return (
        people.groupBy("customer_state")
        .agg(n_rows().alias("customers"), _repeat_pct().alias("repeat_pct"))
        .where(F.col("customers") >= min_customers)
        .orderBy(F.desc("repeat_pct"), "customer_state")
    )


def payment_mix(star: Star) -> DataFrame:
    """Orders, mean value, mean longest plan and paid total per first payment type.

    Orders without a payment drop out; what was paid includes freight, the order value
    does not.
    """
    paid = star.orders.where(F.col("payment_sk").isNotNull())
    grouped = paid.groupBy("primary_payment_type").agg(
        n_rows().alias("orders"),
        F.sum("revenue_cents").alias("cents"),
        F.sum("paid_cents").alias("paid_cents"),
        F.sum(F.col("max_installments").cast("bigint")).alias("plans"),
        F.count("max_installments").alias("with_plan"),
    )
    return grouped.select(
        "primary_payment_type",
        "orders",
        mean_cents(F.col("cents"), F.col("orders")).alias("avg_order_value"),
        mean_2dp(F.col("plans"), F.col("with_plan")).alias("avg_max_installments"),
        from_cents(F.col("paid_cents")).alias("total_paid"),
    ).orderBy(F.desc("total_paid"), "primary_payment_type")
