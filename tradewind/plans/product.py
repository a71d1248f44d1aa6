"""Categories and prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import from_cents, mean_cents, percent_2dp
from tradewind.operators.star import UNTRANSLATED, Star
from tradewind.plans.common import late_share, mean_where, money, n_rows

# Upper limits and labels of the price bands.
PRICE_BANDS = (
    (50, "A) < 50"),
    (100, "B) 50-99"),
    (200, "C) 100-199"),
    (500, "D) 200-499"),
    (None, "E) 500+"),
)


def _by_category(star: Star) -> DataFrame:
    """Lines and revenue per category; at most one row per translation entry."""
    return star.lines.groupBy("category").agg(
        n_rows().alias("units_sold"), F.sum("price_cents").alias("revenue_cents")
    )


def top_categories(star: Star, limit: int = 15) -> DataFrame:
    """Best categories by revenue, with rank and share of all revenue."""
    everything = Window.partitionBy()
    ranked = _by_category(star).select(
        "category",
        "units_sold",
        *money(revenue="revenue_cents"),
        mean_cents(F.col("revenue_cents"), F.col("units_sold")).alias("avg_price"),
        F.rank().over(Window.orderBy(F.desc("revenue_cents"))).alias("revenue_rank"),
        percent_2dp(F.col("revenue_cents"), F.sum("revenue_cents").over(everything)).alias(
            "pct_of_total_revenue"
        ),
    )
    return ranked.orderBy(F.desc("revenue"), "category").limit(limit)


def volume_below_avg_price(star: Star, min_units: int = 500) -> DataFrame:
    """Categories selling many units below the average price of all lines."""
    wide = "decimal(20,0)"
    # Both averages come from the category totals, so the lines are read once.
    everything = Window.partitionBy()
    totals = _by_category(star).select(
        "category",
        "units_sold",
        "revenue_cents",
        F.sum("revenue_cents").over(everything).alias("all_cents"),
        F.sum("units_sold").over(everything).alias("all_units"),
    )
    own = F.col("revenue_cents").cast(wide) * F.col("all_units").cast("decimal(18,0)")
    overall = F.col("all_cents").cast(wide) * F.col("units_sold").cast("decimal(18,0)")
    return (
        totals.where((F.col("units_sold") >= min_units) & (own < overall))
        .select(
            "category",
            "units_sold",
            mean_cents(F.col("revenue_cents"), F.col("units_sold")).alias("avg_item_price"),
        )
        .orderBy(F.desc("units_sold"), "category")
    )


def price_bands(star: Star, limits: tuple[int, ...] = (50, 100, 200, 500)) -> DataFrame:
    """Lines, revenue and mean freight per price band; the labels keep their names."""
    labels = [label for _, label in PRICE_BANDS]
    steps = list(zip(limits, labels))
    first = F.when(F.col("price_cents") < 100 * steps[0][0], steps[0][1])
    band = reduce(
        lambda chain, step: chain.when(F.col("price_cents") < 100 * step[0], step[1]),
        steps[1:],
        first,
    ).otherwise(labels[-1])
    grouped = star.lines.groupBy(band.alias("price_band")).agg(
        n_rows().alias("items"),
        F.sum("price_cents").alias("revenue_cents"),
        F.sum("freight_cents").alias("freight_cents"),
    )
    return grouped.select(
        "price_band",
        "items",
        *money(revenue="revenue_cents"),
        mean_cents(F.col("freight_cents"), F.col("items")).alias("avg_freight"),
    ).orderBy("price_band")


def category_delivery_quality(star: Star, min_lines: int = 200, limit: int = 20) -> DataFrame:
    """Translated categories with many lines, worst lateness first."""
    grouped = (
        star.lines.where(F.col("category") != UNTRANSLATED)
        .groupBy("category")
        .agg(
            n_rows().alias("lines"),
            from_cents(F.sum("price_cents")).alias("revenue"),
            mean_where("delivery_days").alias("avg_delivery_days"),
            late_share().alias("late_pct"),
            mean_where("review_score").alias("avg_review"),
        )
    )
    return (
        grouped.where(F.col("lines") >= min_lines)
        .drop("lines")
        .orderBy(F.desc_nulls_first("late_pct"), "category")
        .limit(limit)
    )


def pareto_categories(star: Star, share: str = "0.80") -> DataFrame:
    """Categories that together make up `share` of revenue, the crossing one included."""
    best_first = Window.orderBy(F.desc("revenue_cents"), "category")
    so_far = best_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = _by_category(star).select(
        "category",
        "revenue_cents",
        F.sum("revenue_cents").over(so_far).alias("running"),
        F.sum("revenue_cents").over(Window.partitionBy()).alias("total"),
    )
    wanted = F.lit(share).cast("decimal(4,3)") * F.col("total").cast("decimal(20,0)")
    # The running total before a category never exceeds the one after it, so this one
    # test also covers categories that end below the share.
    before = F.col("running") - F.col("revenue_cents")
    kept = summed.where((before <= wanted) | (F.col("running") <= wanted))
    return kept.select(
        "category",
        *money(revenue="revenue_cents"),
        percent_2dp(F.col("running"), F.col("total")).alias("cumulative_pct"),
    ).orderBy(F.desc("revenue"), "category")


def kpi_top_category(star: Star) -> DataFrame:
    """The best-selling category, with ties."""
    first = F.rank().over(Window.orderBy(F.desc("revenue_cents")))
    ranked = _by_category(star).withColumn("_rank", first).where("_rank = 1")
    return ranked.select("category", *money(revenue="revenue_cents"))
