"""Seller acquisition: leads, deals and what acquired sellers then sell.

A seller named by two deals contributes revenue to both: amounts fan out on purpose and
distinct counts do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import days_between, from_cents, mean_2dp, mean_cents, percent_2dp
from tradewind.operators.star import Star
from tradewind.plans.common import money, n_rows
from tradewind.plans.delivery import bucket
from tradewind.session import work_path
from tradewind.sources.tables import materialize_table

# Upper limits in days and labels of the closing-speed buckets.
CLOSE_BUCKETS = (
    (7, "0-7 days"),
    (30, "8-30 days"),
    (90, "31-90 days"),
    (None, "90+ days"),
)


def _leads_with_outcome(star: Star) -> DataFrame:
    """One row per lead with whether it closed.

    Both sides are reduced to unique lead ids first, so plain counts replace distinct ones.
    """
    leads = star.clean["qualified_leads"].select("mql_id", "origin").distinct()
    won = star.clean["closed_deals"].select("mql_id").distinct().withColumn("won", F.lit(True))
    return leads.join(won, "mql_id", "left")


def funnel_conversion(star: Star) -> DataFrame:
    leads = _leads_with_outcome(star).groupBy("mql_id").agg(F.max("won").alias("won"))
    totals = leads.agg(n_rows().alias("total_mqls"), F.count("won").alias("closed_deals"))
    return totals.withColumn(
        "conversion_pct", percent_2dp(F.col("closed_deals"), F.col("total_mqls"))
    )


def funnel_by_origin(star: Star) -> DataFrame:
    """Leads, deals and conversion per origin; origins without a deal are kept."""
    return (
        _leads_with_outcome(star)
        .groupBy("origin")
        .agg(n_rows().alias("mqls"), F.count("won").alias("closed"))
        .withColumn("conversion_pct", percent_2dp(F.col("closed"), F.col("mqls")))
        .orderBy(F.desc("conversion_pct"), F.desc("mqls"), "origin")
    )


def declared_revenue_by_type(star: Star) -> DataFrame:
    declared = F.col("cents")
    positive = F.when(declared > 0, declared)
    deals = star.clean["closed_deals"].select(
        F.coalesce("business_type", F.lit("unknown")).alias("business_type"),
        (F.col("declared_monthly_revenue") * 100).cast("bigint").alias("cents"),
    )
    return (
        deals.groupBy("business_type")
        .agg(
            n_rows().alias("sellers_closed"),
            mean_cents(F.sum(positive), F.count(positive)).alias("avg_positive_declared_revenue"),
            from_cents(F.sum(declared)).alias("total_declared_revenue"),
        )
        .orderBy(F.desc_nulls_last("total_declared_revenue"), "business_type")
    )


def _deals_with_lead(star: Star) -> DataFrame:
    leads = star.clean["qualified_leads"].select("mql_id", "origin", "first_contact_date")
    return star.clean["closed_deals"].join(leads, "mql_id")


def _seller_deals(star: Star, deals: DataFrame, *columns: str) -> DataFrame:
    """Deals whose seller is in the marketplace, equal ones folded with their number."""
    sellers = star.dims["dim_seller"].select("seller_id", "seller_sk")
    return deals.join(sellers, "seller_id").groupBy("seller_sk", *columns).agg(
        n_rows().alias("deals")
    )


def _stored(deals: DataFrame) -> DataFrame:
    """Seller deals as a stored table of known size.

    While they are small they are broadcast, and the seller book crosses no exchange to meet
    them; computed in the same plan they would be known to be small when it has crossed.
    """
    return materialize_table(deals, work_path(deals.sparkSession, "seller-deals"))


def acquired_seller_gmv(star: Star, limit: int = 30) -> DataFrame:
    """Sellers, orders and GMV per business type and lead origin of the deal."""
    deals = _stored(_seller_deals(star, _deals_with_lead(star), "business_type", "origin"))
    group = ["business_type", "lead_origin"]
    # An order can hold lines of several acquired sellers, and one seller many orders.  Every
    # row of the seller book stands for its order and for its seller; both are reduced to the
    # groups they belong to, on the map side first, and plain counts are left.
    order = F.struct(
        F.lit("order").alias("kind"),
        F.col("order_sk").alias("id"),
        (F.col("price_cents") * F.col("deals")).alias("cents"),
    )
    seller = F.struct(
        F.lit("seller").alias("kind"),
        F.col("seller_sk").alias("id"),
        F.lit(None).cast("bigint").alias("cents"),
    )
    sold = star.sellers.select("seller_sk", "order_sk", "price_cents").join(deals, "seller_sk")
    members = (
        sold.select(
            "business_type", F.col("origin").alias("lead_origin"), F.inline(F.array(order, seller))
        )
        .groupBy(*group, "kind", "id")
        .agg(F.sum("cents").alias("cents"))
    )
    return (
        members.groupBy(*group)
        .agg(
            F.count_if(F.col("kind") == "seller").alias("acquired_sellers"),
            F.count_if(F.col("kind") == "order").alias("marketplace_orders"),
            F.sum("cents").alias("cents"),
        )
        .select(
            *group, "acquired_sellers", "marketplace_orders", *money(marketplace_gmv="cents")
        )
        .orderBy(F.desc_nulls_last("marketplace_gmv"), *group)
        .limit(limit)
    )


def time_to_close(star: Star, buckets=CLOSE_BUCKETS) -> DataFrame:
    """Deals per days from first contact to closing; deals closed before it are left out."""
    days = days_between(F.col("first_contact_date"), F.col("won_date"))
    timed = _deals_with_lead(star).select(days.alias("days")).where("days >= 0")
    return (
        timed.groupBy(bucket(F.col("days"), buckets).alias("close_speed_bucket"))
        .agg(n_rows().alias("deals"), F.min("days").alias("_fastest"))
        .orderBy("_fastest")
        .drop("_fastest")
    )


def acquired_delivery_quality(star: Star, min_orders: int = 20) -> DataFrame:
    """Delivery and reviews of acquired sellers' delivered lines per business type."""
    kind = F.coalesce("business_type", F.lit("unknown")).alias("business_type")
    won = star.clean["closed_deals"].select("seller_id", kind)
    deals = _stored(_seller_deals(star, won, "business_type"))
    orders = star.sellers.where("is_delivered").select(
        "seller_sk", "order_sk", "line_count", "delivery_days", "is_late_delivery", "review_score"
    )
    # A seller with several deals of a type counts once for each.
    lines = F.col("line_count") * F.col("deals")
    timed = F.when(F.col("delivery_days").isNotNull(), lines)
    reviewed = F.when(F.col("review_score").isNotNull(), lines)
    # An order with lines of several sellers of a type is one order: reduced to its types first.
    per_order = (
        orders.join(deals, "seller_sk")
        .groupBy("order_sk", "business_type")
        .agg(
            F.sum(F.col("delivery_days") * lines).alias("days"),
            F.sum(timed).alias("timed"),
            F.sum(F.when(F.col("is_late_delivery"), lines).otherwise(0)).alias("late"),
            F.sum(lines).alias("lines"),
            F.sum(F.col("review_score") * lines).alias("stars"),
            F.sum(reviewed).alias("reviewed"),
        )
    )
    return (
        per_order.groupBy("business_type")
        .agg(
            n_rows().alias("orders"),
            mean_2dp(F.sum("days"), F.sum("timed")).alias("avg_delivery_days"),
            percent_2dp(F.sum("late"), F.sum("lines")).alias("late_pct"),
            mean_2dp(F.sum("stars"), F.sum("reviewed")).alias("avg_review"),
        )
        .where(F.col("orders") >= min_orders)
        .orderBy(F.desc("late_pct"), "business_type")
    )


def origin_gmv(star: Star) -> DataFrame:
    """Sellers, GMV and line-weighted reviews per lead origin.

    Lines are summed per seller before they meet the deals.
    """
    deals = _seller_deals(star, _deals_with_lead(star), "origin")
    reviewed = F.when(F.col("review_score").isNotNull(), F.col("line_count"))
    per_seller = star.sellers.groupBy("seller_sk").agg(
        F.sum("price_cents").alias("cents"),
        F.sum(F.col("review_score") * F.col("line_count")).alias("stars"),
        F.coalesce(F.sum(reviewed), F.lit(0)).alias("reviews"),
    )
    times = F.col("deals")
    return (
        deals.join(per_seller, "seller_sk")
        .groupBy("origin")
        .agg(
            n_rows().alias("closed_sellers_in_marketplace"),
            from_cents(F.sum(F.col("cents") * times)).alias("attributed_gmv"),
            mean_2dp(F.sum(F.col("stars") * times), F.sum(F.col("reviews") * times)).alias(
                "avg_review"
            ),
        )
        .orderBy(F.desc("attributed_gmv"), "origin")
    )
