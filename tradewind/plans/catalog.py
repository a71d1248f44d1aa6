"""Every statement of the suite by name: 21 quality checks, 23 analyses, 15 business queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tradewind.operators import quality
from tradewind.operators.star import Star
from tradewind.plans import customer, delivery, funnel, growth, kpi, product, revenue, seller


@dataclass(frozen=True)
class Metric:
    name: str
    group: str
    plan: Callable[..., DataFrame]
    reads: str  # "star" or "clean"

    def run(self, star: Star, **thresholds) -> DataFrame:
        return self.plan(star if self.reads == "star" else star.clean, **thresholds)


def _group(group: str, reads: str, plans: dict[str, Callable[..., DataFrame]]) -> list[Metric]:
    return [Metric(name, group, plan, reads) for name, plan in plans.items()]


METRICS: dict[str, Metric] = {
    m.name: m
    for m in [
        *_group(
            "marketplace_quality",
            "clean",
            {
                "dq_duplicate_keys": quality.duplicate_key_counts,
                "dq_orphans": quality.orphan_counts,
                "dq_null_customers": quality.null_customer_fields,
                "dq_null_orders": quality.null_order_fields,
                "dq_approval_before_purchase": quality.approval_before_purchase,
                "dq_delivered_before_carrier": quality.delivered_before_carrier,
                "dq_delivered_missing_date": quality.delivered_missing_date,
                "dq_canceled_but_delivered": quality.canceled_but_delivered,
                "dq_non_positive_price": quality.non_positive_price,
                "dq_freight_gt_price": quality.freight_gt_price,
                "dq_invalid_scores": quality.invalid_review_scores,
                "dq_untranslated_categories": quality.untranslated_categories,
                "dq_volume_snapshot": quality.volume_snapshot,
            },
        ),
        *_group(
            "funnel_quality",
            "clean",
            {
                "dq_duplicate_leads": quality.duplicate_leads,
                "dq_duplicate_deals": quality.duplicate_deals,
                "dq_orphan_deals": quality.orphan_deals,
                "dq_won_before_contact": quality.won_before_contact,
                "dq_seller_linkage": quality.seller_linkage,
                "dq_funnel_dropoff": quality.funnel_dropoff,
                "dq_origin_share": quality.origin_share,
                "dq_revenue_completeness": quality.revenue_completeness,
            },
        ),
        *_group(
            "analysis",
            "star",
            {
                "monthly_gmv": revenue.monthly_gmv,
                "yearly_gmv": revenue.yearly_gmv,
                "top_categories": product.top_categories,
                "volume_below_avg_price": product.volume_below_avg_price,
                "price_bands": product.price_bands,
                "top_sellers": seller.top_sellers,
                "risky_sellers": seller.risky_sellers,
                "seller_state_contribution": seller.seller_state_contribution,
                "repeat_vs_one_time": customer.repeat_vs_one_time,
                "top_customers": customer.top_customers,
                "customers_without_reviews": customer.customers_without_reviews,
                "rfm_segments": customer.rfm_segments,
                "delivery_summary": delivery.delivery_summary,
                "late_by_state": delivery.late_by_state,
                "late_vs_reviews": delivery.late_vs_reviews,
                "delivery_buckets": delivery.delivery_buckets,
                "new_vs_returning": growth.new_vs_returning,
                "cohort_retention": growth.cohort_retention,
                "repeat_90d": growth.repeat_90d,
                "rolling_7d": revenue.rolling_7d,
                "category_delivery_quality": product.category_delivery_quality,
                "payment_mix": customer.payment_mix,
                "sellers_above_category_avg": seller.sellers_above_category_avg,
            },
        ),
        *_group(
            "business",
            "star",
            {
                "kpi_snapshot": kpi.kpi_snapshot,
                "kpi_on_time": delivery.kpi_on_time,
                "kpi_top_category": product.kpi_top_category,
                "kpi_repeat_rate": customer.kpi_repeat_rate,
                "funnel_conversion": funnel.funnel_conversion,
                "funnel_by_origin": funnel.funnel_by_origin,
                "declared_revenue_by_type": funnel.declared_revenue_by_type,
                "acquired_seller_gmv": funnel.acquired_seller_gmv,
                "time_to_close": funnel.time_to_close,
                "acquired_delivery_quality": funnel.acquired_delivery_quality,
                "demo_monthly_mom": revenue.demo_monthly_mom,
                "pareto_categories": product.pareto_categories,
                "demo_late_ratings": delivery.demo_late_ratings,
                "repeat_by_state": customer.repeat_by_state,
                "origin_gmv": funnel.origin_gmv,
            },
        ),
    ]
}


def _columns(plan: Callable[[Star], DataFrame], *names: str) -> Callable[[Star], DataFrame]:
    return lambda star: plan(star).select(*names)


# The insight pack: narrower views of metrics above, by their name in the pack.
INSIGHTS: dict[str, Callable[[Star], DataFrame]] = {
    "snapshot": _columns(
        kpi.kpi_snapshot,
        "total_orders",
        "unique_customers",
        "active_sellers",
        "total_gmv",
        "avg_review_score",
    ),
    "late_vs_ontime_reviews": delivery.demo_late_ratings,
    "repeat_rate": customer.kpi_repeat_rate,
    "top_categories": _columns(
        lambda star: product.top_categories(star, limit=5), "category", "revenue"
    ),
    "funnel": funnel.funnel_conversion,
    "on_time_pct": delivery.kpi_on_time,
}
# Insights that hold exactly one row are stored as an object, the others as a list.
SINGLE_ROW_INSIGHTS = ("snapshot", "repeat_rate", "funnel", "on_time_pct")
