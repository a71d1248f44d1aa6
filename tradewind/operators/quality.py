"""Data-quality suites over the typed marketplace and funnel tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import percent_2dp
from tradewind.operators.integrity import orphans, repeated_keys

Tables = Mapping[str, DataFrame]


def count_of(rows: DataFrame, name: str = "n") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def named_counts(parts: Mapping[str, DataFrame], label: str, value: str) -> DataFrame:
    """One (label, count) row per DataFrame."""
    rows = [count_of(df, value).select(F.lit(n).alias(label), value) for n, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def one_row(df: DataFrame, **scalars: Column) -> DataFrame:
    """A single row of scalar subqueries."""
    base = df.sparkSession.range(1, numPartitions=1)
    return base.select(*[c.alias(n) for n, c in scalars.items()])


# --- marketplace ----------------------------------------------------------------------


def duplicate_key_counts(t: Tables) -> DataFrame:
    return named_counts(
        {
            "dup_customers": repeated_keys(t["customers"], ["customer_id"]),
            "dup_orders": repeated_keys(t["orders"], ["order_id"]),
            # Lines of an order mostly lie next to each other.
            "dup_order_items": repeated_keys(
                t["order_items"], ["order_id", "order_item_id"], deal_by=["order_id"]
            ),
        },
        "check_name",
        "failures",
    )


def orphan_counts(t: Tables) -> DataFrame:
    def lost(child: str, column: str, parent: str) -> DataFrame:
        return orphans(t[child].select(column), t[parent], [column], [column])

    return named_counts(
        {
            "orphan_orders_customer": lost("orders", "customer_id", "customers"),
            "orphan_items_order": lost("order_items", "order_id", "orders"),
            "orphan_items_product": lost("order_items", "product_id", "products"),
            "orphan_items_seller": lost("order_items", "seller_id", "sellers"),
        },
        "check_name",
        "failures",
    )


def _nulls(column: str) -> Column:
    """Number of NULLs; itself NULL over no rows, as a SUM is."""
    return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0))


def null_customer_fields(t: Tables) -> DataFrame:
    return t["customers"].agg(
        _nulls("customer_id").alias("null_customer_pk"),
        _nulls("customer_unique_id").alias("null_unique_id"),
    )


def null_order_fields(t: Tables) -> DataFrame:
    return t["orders"].agg(
        _nulls("order_id").alias("null_order_pk"),
        _nulls("order_purchase_timestamp").alias("null_purchase_ts"),
    )


def _order_rules() -> dict[str, Column]:
    delivered = F.col("order_delivered_customer_date")
    status = F.col("order_status")
    return {
        "approval_before_purchase": F.col("order_approved_at") < F.col("order_purchase_timestamp"),
        "delivered_before_carrier": delivered < F.col("order_delivered_carrier_date"),
        "delivered_missing_date": (status == "delivered") & delivered.isNull(),
        "canceled_but_delivered": (status == "canceled") & delivered.isNotNull(),
    }


def _item_rules() -> dict[str, Column]:
    return {
        "non_positive_price": F.col("price") <= 0,
        "freight_gt_price": F.col("freight_value") > F.col("price"),
    }


def order_rule_counts(t: Tables) -> DataFrame:
    """All order rules in one pass over the orders."""
    return t["orders"].agg(*[F.count_if(bad).alias(n) for n, bad in _order_rules().items()])


def item_rule_counts(t: Tables) -> DataFrame:
    """All line rules in one pass over the lines."""
    return t["order_items"].agg(*[F.count_if(bad).alias(n) for n, bad in _item_rules().items()])


def _single(fused):
    def build(name: str):
        return lambda t: fused(t).select(name)

    return build


# One column of a fused pass: the optimizer drops the other counters.
_order_rule, _item_rule = _single(order_rule_counts), _single(item_rule_counts)
approval_before_purchase = _order_rule("approval_before_purchase")
delivered_before_carrier = _order_rule("delivered_before_carrier")
delivered_missing_date = _order_rule("delivered_missing_date")
canceled_but_delivered = _order_rule("canceled_but_delivered")
non_positive_price = _item_rule("non_positive_price")
freight_gt_price = _item_rule("freight_gt_price")


def invalid_review_scores(t: Tables) -> DataFrame:
    bad = ~F.col("review_score").between(1, 5)
    return t["order_reviews"].agg(F.count_if(bad).alias("invalid_review_scores"))


def untranslated_categories(t: Tables) -> DataFrame:
    name = "product_category_name"
    used = t["products"].where(F.col(name).isNotNull()).select(name).distinct()
    missing = used.join(t["category_translation"].select(name), name, "left_anti")
    return count_of(missing, "untranslated_categories")


def volume_snapshot(t: Tables) -> DataFrame:
    names = ["customers", "orders", "order_items", "sellers", "products"]
    return one_row(t["orders"], **{n: count_of(t[n]).scalar() for n in names})


# --- acquisition funnel ---------------------------------------------------------------


def duplicate_leads(t: Tables) -> DataFrame:
    return repeated_keys(t["qualified_leads"], ["mql_id"])


def duplicate_deals(t: Tables) -> DataFrame:
    return repeated_keys(t["closed_deals"], ["mql_id"])


def orphan_deals(t: Tables) -> DataFrame:
    lost = orphans(t["closed_deals"], t["qualified_leads"], ["mql_id"], ["mql_id"])
    return count_of(lost, "orphan_closed_deals")


def won_before_contact(t: Tables) -> DataFrame:
    pairs = t["closed_deals"].join(t["qualified_leads"], "mql_id")
    early = pairs.where(F.col("won_date") < F.col("first_contact_date"))
    return count_of(early, "won_before_contact")


def seller_linkage(t: Tables) -> DataFrame:
    known = t["sellers"].select("seller_id", F.lit(True).alias("_known"))
    linked = t["closed_deals"].select("seller_id").join(known, "seller_id", "left")
    totals = linked.agg(
        F.count(F.lit(1)).alias("closed_deals"), F.count("_known").alias("matched_sellers")
    )
    return totals.withColumn(
        "pct_matched", percent_2dp(F.col("matched_sellers"), F.col("closed_deals"))
    )


def funnel_dropoff(t: Tables) -> DataFrame:
    totals = one_row(
        t["qualified_leads"],
        total_mqls=count_of(t["qualified_leads"]).scalar(),
        closed_deals=count_of(t["closed_deals"]).scalar(),
    )
    return totals.withColumn(
        "conversion_pct", percent_2dp(F.col("closed_deals"), F.col("total_mqls"))
    )


def origin_share(t: Tables) -> DataFrame:
    leads = t["qualified_leads"].groupBy("origin").agg(F.count(F.lit(1)).alias("leads"))
    return leads.orderBy(F.desc("leads"), "origin")


def revenue_completeness(t: Tables) -> DataFrame:
    declared = F.col("declared_monthly_revenue")
    return t["closed_deals"].agg(
        percent_2dp(F.count(declared), F.count(F.lit(1))).alias("pct_with_revenue"),
        percent_2dp(F.count_if(declared > 0), F.count(F.lit(1))).alias(
            "pct_with_positive_revenue"
        ),
    )
