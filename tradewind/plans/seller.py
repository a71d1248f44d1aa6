"""Seller performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import from_cents, mean_cents
from tradewind.operators.star import Star
from tradewind.plans.common import late_share, money, n_rows, weighted_mean


def _named(per_seller: DataFrame, star: Star) -> DataFrame:
    """Seller id and state for rows of seller grain."""
    names = star.dims["dim_seller"].select("seller_sk", "seller_id", "seller_state")
    return per_seller.join(names, "seller_sk")


def top_sellers(star: Star, min_orders: int = 10, limit: int = 20) -> DataFrame:
    """Best sellers by GMV among those with enough orders."""
    per_seller = star.sellers.groupBy("seller_sk").agg(
        n_rows().alias("orders"),
        F.sum("line_count").alias("items"),
        F.sum("price_cents").alias("gmv_cents"),
        weighted_mean("review_score").alias("avg_review"),
    )
    best = (
        _named(per_seller.where(F.col("orders") >= min_orders), star)
        .orderBy(F.desc("gmv_cents"), "seller_id")
        .limit(limit)
    )
    # A dense rank depends on better rows only, and those are all kept: ranking after the
    # limit gives the same numbers without sorting every seller in one task.
    rank = F.dense_rank().over(Window.orderBy(F.desc("gmv_cents")))
    return best.select(
        "seller_id",
        "seller_state",
        "orders",
        "items",
        *money(gmv="gmv_cents"),
        "avg_review",
        rank.alias("gmv_rank"),
    ).orderBy(F.desc("gmv"), "seller_id")


def risky_sellers(
    star: Star, min_orders: int = 50, max_review: str = "3.5", limit: int = 25
) -> DataFrame:
    """Sellers with many orders and weak reviews, biggest first."""
    reviewed = F.when(F.col("review_score").isNotNull(), F.col("line_count"))
    per_seller = star.sellers.groupBy("seller_sk").agg(
        n_rows().alias("orders"),
        from_cents(F.sum("price_cents")).alias("gmv"),
        weighted_mean("review_score").alias("avg_review"),
        late_share("line_count").alias("late_delivery_pct"),
        F.sum(F.col("review_score") * F.col("line_count")).alias("_stars"),
        F.coalesce(F.sum(reviewed), F.lit(0)).alias("_reviews"),
    )
    bound = F.lit(max_review).cast("decimal(4,2)") * F.col("_reviews").cast("decimal(18,0)")
    weak = F.col("_stars").cast("decimal(20,2)") < bound
    risky = per_seller.where((F.col("orders") >= min_orders) & weak)
    return (
        _named(risky, star)
        .select("seller_id", "seller_state", "orders", "gmv", "avg_review", "late_delivery_pct")
        .orderBy(F.desc("gmv"), "seller_id")
        .limit(limit)
    )


def seller_state_contribution(star: Star, lines: DataFrame | None = None) -> DataFrame:
    """Sellers, lines and GMV per seller state; sellers without a sale are kept.

    Lines are reduced to one row per seller before the outer join, so a best-selling
    seller reaches the join as a single row.
    """
    lines = star.lines if lines is None else lines
    per_seller = lines.groupBy("seller_sk").agg(
        n_rows().alias("_lines"), F.sum("price_cents").alias("_cents")
    )
    sellers = star.dims["dim_seller"].select("seller_sk", "seller_state")
    joined = per_seller.join(sellers, "seller_sk", "right")
    return (
        joined.groupBy(F.coalesce("seller_state", F.lit("UNK")).alias("seller_state"))
        .agg(
            n_rows().alias("sellers"),
            F.coalesce(F.sum("_lines"), F.lit(0)).alias("items_sold"),
            from_cents(F.sum("_cents")).alias("gmv"),
        )
        .orderBy(F.desc_nulls_last("gmv"), "seller_state")
    )


def sellers_above_category_avg(star: Star, factor: str = "3", limit: int = 25) -> DataFrame:
    """Sellers whose revenue in a category exceeds `factor` times its mean per seller.

    The mean is taken by a second aggregation joined back, not by a window: a category
    holding most sellers would put them all into one window task.
    """
    # The joins below need both columns filled; asked for here, both uses of the pairs are the
    # same plan and share one exchange.
    lines = star.lines.where(F.col("seller_sk").isNotNull() & F.col("category").isNotNull())
    pairs = lines.groupBy("seller_sk", "category").agg(
        F.sum("price_cents").alias("revenue_cents")
    )
    means = pairs.groupBy("category").agg(
        F.sum("revenue_cents").alias("category_cents"), n_rows().alias("sellers")
    )
    own = F.col("revenue_cents").cast("decimal(20,0)") * F.col("sellers").cast("decimal(14,0)")
    wanted = F.lit(factor).cast("decimal(6,3)") * F.col("category_cents").cast("decimal(20,0)")
    return (
        _named(pairs.join(means, "category").where(own > wanted), star)
        .select(
            "seller_id",
            "category",
            *money(seller_cat_revenue="revenue_cents"),
            mean_cents(F.col("category_cents"), F.col("sellers")).alias(
                "category_avg_seller_revenue"
            ),
        )
        .orderBy(F.desc("seller_cat_revenue"), "seller_id", "category")
        .limit(limit)
    )
