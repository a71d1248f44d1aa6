"""DuckDB SQL for every query, written against the raw test tables.

Each entry is a column list and a body.  The list fixes output types: `i` BIGINT, `d` DATE,
`t` timestamp, `s` text, `b` boolean, `f` double, `h` hundredths held as an integer and
shown as a double.  Ratios are rounded half away from zero on integers.
"""

from __future__ import annotations

import re

from oracles.roles import duckdb_ctes
from tradewind.sources.contracts import CLEAN_TABLES as CONTRACTS


def H(n: str, d: str, factor: int) -> str:
    """round(factor * n / d) half away from zero; NULL for a zero divisor."""
    return (
        f"(case when ({d}) = 0 then null else cast(sign({n}) as hugeint) * "
        f"((2 * {factor} * abs(cast({n} as hugeint)) + ({d})) // (2 * ({d}))) end)"
    )


def PCT(n: str, d: str) -> str:
    return H(n, d, 10_000)


def AVG(column: str, where: str = "true") -> str:
    total = f"sum(cast({column} as hugeint)) filter ({where})"
    return H(total, f"count({column}) filter ({where})", 100)


def MEAN_CENTS(total: str, n: str) -> str:
    return H(total, n, 1)


LATE = PCT("count(*) filter (is_late)", "count(*)")

SHARED = """
reviews as (
  select * from r_reviews_all
  qualify row_number() over (partition by review_id
    order by review_creation_date desc nulls last, order_id) = 1),
order_review as (
  select * from reviews
  qualify row_number() over (partition by order_id
    order by review_creation_date desc nulls last, review_id) = 1),
order_payment as (
  select order_id, arg_min(payment_type, payment_sequential) as primary_payment_type,
         count(*) as payment_count, sum(cast(payment_value * 100 as bigint)) as paid,
         max(payment_installments) as max_installments
  from r_payments group by order_id),
delivery as (
  select *, cast(order_purchase_timestamp as date) as day,
         date_diff('day', cast(order_purchase_timestamp as date),
                   cast(order_delivered_customer_date as date)) as delivery_days,
         date_diff('day', cast(order_purchase_timestamp as date),
                   cast(order_estimated_delivery_date as date)) as estimated_days,
         date_diff('day', cast(order_estimated_delivery_date as date),
                   cast(order_delivered_customer_date as date)) as delay_days,
         order_delivered_customer_date > order_estimated_delivery_date as is_late
  from r_orders),
line as (
  select i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
         i.price, i.freight_value, cast(i.price * 100 as bigint) as cents,
         cast(i.freight_value * 100 as bigint) as fcents,
         d.customer_id, d.order_status, d.order_delivered_customer_date, d.day,
         d.delivery_days, d.is_late, c.customer_unique_id as person, c.customer_state,
         coalesce(t.product_category_name_english, 'untranslated') as category,
         s.seller_state, v.review_id, v.review_score
  from r_items i
  join delivery d on d.order_id = i.order_id
  join r_customers c on c.customer_id = d.customer_id
  join r_products p on p.product_id = i.product_id
  left join r_translation t on t.product_category_name = p.product_category_name
  join r_sellers s on s.seller_id = i.seller_id
  left join order_review v on v.order_id = i.order_id)
"""

_CASTS = {
    "i": "cast({c} as bigint)",
    "d": "cast({c} as date)",
    "t": "cast({c} as timestamp)",
    "s": "cast({c} as varchar)",
    "b": "cast({c} as boolean)",
    "f": "cast({c} as double)",
    "h": "cast({c} as double) / 100",
}

# Thresholds: (metric, parameter) -> value on the test data; the plan's own default is used
# by the suite.
TEST_THRESHOLDS: dict[str, dict] = {
    "price_bands": {"limits": (5_000, 10_000, 20_000, 50_000)},
    "late_by_state": {"min_orders": 300},
    "category_delivery_quality": {"min_lines": 2_300},
    "sellers_above_category_avg": {"factor": "1.5"},
    "repeat_by_state": {"min_customers": 300},
}
DEFAULT_THRESHOLDS: dict[str, dict] = {
    "price_bands": {"limits": (50, 100, 200, 500)},
    "late_by_state": {"min_orders": 100},
    "category_delivery_quality": {"min_lines": 200},
    "sellers_above_category_avg": {"factor": "3"},
    "repeat_by_state": {"min_customers": 500},
}

# Checks that the test data breaks on purpose: they read the x_* tables.
BROKEN_CHECKS = (
    "dq_duplicate_keys",
    "dq_orphans",
    "dq_null_customers",
    "dq_null_orders",
    "dq_non_positive_price",
    "dq_invalid_scores",
    "dq_duplicate_leads",
    "dq_duplicate_deals",
    "dq_orphan_deals",
)


def on_broken_tables(body: str) -> str:
    body = body.replace("from reviews", "from x_reviews")
    for table in ("customers", "orders", "items", "products", "sellers", "leads", "deals"):
        body = re.sub(rf"\br_{table}\b", f"x_{table}", body)
    return body


def _band_sql(limits: tuple[int, ...]) -> str:
    labels = ["A) < 50", "B) 50-99", "C) 100-199", "D) 200-499"]
    steps = " ".join(f"when price < {x} then '{label}'" for x, label in zip(limits, labels))
    return f"case {steps} else 'E) 500+' end"


def metric_entries(th: dict[str, dict]) -> dict[str, tuple[str, str]]:
    """The 59 metrics under the given thresholds."""
    e: dict[str, tuple[str, str]] = {}

    # --- quality ---
    e["dq_duplicate_keys"] = (
        "check_name:s failures:i",
        " union all ".join(
            f"""select '{label}' as check_name, count(*) as failures from (
                  select 1 from {table} group by {key} having count(*) > 1) x"""
            for label, table, key in (
                ("dup_customers", "r_customers", "customer_id"),
                ("dup_orders", "r_orders", "order_id"),
                ("dup_order_items", "r_items", "order_id, order_item_id"),
            )
        ),
    )
    e["dq_orphans"] = (
        "check_name:s failures:i",
        " union all ".join(
            f"""select '{label}' as check_name, count(*) as failures from {child} c
                where not exists (select 1 from {parent} p where p.{key} = c.{key})"""
            for label, child, parent, key in (
                ("orphan_orders_customer", "r_orders", "r_customers", "customer_id"),
                ("orphan_items_order", "r_items", "r_orders", "order_id"),
                ("orphan_items_product", "r_items", "r_products", "product_id"),
                ("orphan_items_seller", "r_items", "r_sellers", "seller_id"),
            )
        ),
    )
    e["dq_null_customers"] = (
        "null_customer_pk:i null_unique_id:i",
        """select count(*) - count(customer_id) as null_customer_pk,
                  count(*) - count(customer_unique_id) as null_unique_id from r_customers""",
    )
    e["dq_null_orders"] = (
        "null_order_pk:i null_purchase_ts:i",
        """select count(*) - count(order_id) as null_order_pk,
                  count(*) - count(order_purchase_timestamp) as null_purchase_ts from r_orders""",
    )
    for name, table, rule in (
        ("approval_before_purchase", "r_orders", "order_approved_at < order_purchase_timestamp"),
        (
            "delivered_before_carrier",
            "r_orders",
            "order_delivered_customer_date < order_delivered_carrier_date",
        ),
        (
            "delivered_missing_date",
            "r_orders",
            "order_status = 'delivered' and order_delivered_customer_date is null",
        ),
        (
            "canceled_but_delivered",
            "r_orders",
            "order_status = 'canceled' and order_delivered_customer_date is not null",
        ),
        ("non_positive_price", "r_items", "price <= 0"),
        ("freight_gt_price", "r_items", "freight_value > price"),
    ):
        e[f"dq_{name}"] = (f"{name}:i", f"select count(*) as {name} from {table} where {rule}")
    e["dq_invalid_scores"] = (
        "invalid_review_scores:i",
        """select count(*) as invalid_review_scores from reviews
           where review_score < 1 or review_score > 5""",
    )
    e["dq_untranslated_categories"] = (
        "untranslated_categories:i",
        """select count(*) as untranslated_categories from (
             select product_category_name from r_products where product_category_name is not null
             except select product_category_name from r_translation) x""",
    )
    e["dq_volume_snapshot"] = (
        "customers:i orders:i order_items:i sellers:i products:i",
        """select (select count(*) from r_customers) as customers,
                  (select count(*) from r_orders) as orders,
                  (select count(*) from r_items) as order_items,
                  (select count(*) from r_sellers) as sellers,
                  (select count(*) from r_products) as products""",
    )
    for name, table in (("dq_duplicate_leads", "r_leads"), ("dq_duplicate_deals", "r_deals")):
        e[name] = (
            "mql_id:i n:i",
            f"select mql_id, count(*) as n from {table} group by mql_id having count(*) > 1",
        )
    e["dq_orphan_deals"] = (
        "orphan_closed_deals:i",
        """select count(*) as orphan_closed_deals from r_deals d
           where not exists (select 1 from r_leads l where l.mql_id = d.mql_id)""",
    )
    e["dq_won_before_contact"] = (
        "won_before_contact:i",
        """select count(*) as won_before_contact from r_deals d
           where exists (select 1 from r_leads l
                         where l.mql_id = d.mql_id and d.won_date < l.first_contact_date)""",
    )
    e["dq_seller_linkage"] = (
        "closed_deals:i matched_sellers:i pct_matched:h",
        f"""select n as closed_deals, m as matched_sellers, {PCT("m", "n")} as pct_matched
            from (select count(*) as n, count(*) filter (seller_id in
                  (select seller_id from r_sellers)) as m from r_deals) x""",
    )
    e["dq_funnel_dropoff"] = (
        "total_mqls:i closed_deals:i conversion_pct:h",
        f"""select l as total_mqls, d as closed_deals, {PCT("d", "l")} as conversion_pct
            from (select (select count(*) from r_leads) as l,
                         (select count(*) from r_deals) as d) x""",
    )
    e["dq_origin_share"] = (
        "origin:s leads:i",
        "select origin, count(*) as leads from r_leads group by origin",
    )
    e["dq_revenue_completeness"] = (
        "pct_with_revenue:h pct_with_positive_revenue:h",
        f"""select {PCT("count(declared_monthly_revenue)", "count(*)")} as pct_with_revenue,
                   {PCT("count(*) filter (declared_monthly_revenue > 0)", "count(*)")}
                     as pct_with_positive_revenue
            from r_deals""",
    )

    # --- revenue ---
    e["monthly_gmv"] = (
        "year_number:i month_number:i month_name:s orders:i items_sold:i gmv:h freight_cost:h "
        "contribution:h running_gmv:h mom_gmv_growth_pct:h",
        f"""select year(m) as year_number, month(m) as month_number,
                   strftime(m, '%b') as month_name, orders, items_sold, gmv,
                   freight as freight_cost, gmv - freight as contribution,
                   sum(gmv) over (order by m) as running_gmv,
                   {PCT("gmv - prev", "prev")} as mom_gmv_growth_pct
            from (select *, lag(gmv) over (order by m) as prev from (
              select date_trunc('month', day) as m, count(distinct order_id) as orders,
                     count(*) as items_sold, sum(cents) as gmv, sum(fcents) as freight
              from line where order_status <> 'canceled' and order_status <> 'unavailable'
              group by 1) a) b""",
    )
    e["yearly_gmv"] = (
        "year_number:i gmv:h orders:i prior_year_gmv:h yoy_growth_pct:h",
        f"""select y as year_number, gmv, orders, prev as prior_year_gmv,
                   {PCT("gmv - prev", "prev")} as yoy_growth_pct
            from (select *, lag(gmv) over (order by y) as prev from (
              select year(day) as y, sum(cents) as gmv, count(distinct order_id) as orders
              from line group by 1) a) b""",
    )
    e["demo_monthly_mom"] = (
        "month:d gmv:h mom_pct:h",
        f"""select m as month, gmv, {PCT("gmv - prev", "prev")} as mom_pct
            from (select *, lag(gmv) over (order by m) as prev from (
              select date_trunc('month', day) as m, sum(cents) as gmv from line group by 1) a) b""",
    )
    e["rolling_7d"] = (
        "full_date:d daily_orders:i daily_gmv:h orders_7d_rolling:i gmv_7d_avg:h",
        f"""select full_date, daily_orders, daily_gmv, o7 as orders_7d_rolling,
                   {MEAN_CENTS("g7", "n7")} as gmv_7d_avg
            from (select *, sum(daily_orders) over w as o7, sum(daily_gmv) over w as g7,
                         count(*) over w as n7
                  from (select day as full_date, count(distinct order_id) as daily_orders,
                               sum(cents) as daily_gmv from line group by 1) a
                  window w as (order by full_date rows between 6 preceding and current row)) b""",
    )

    # --- categories and prices ---
    cat = "(select category, count(*) as n, sum(cents) as rev from line group by 1)"
    e["top_categories"] = (
        "category:s units_sold:i revenue:h avg_price:h revenue_rank:i pct_of_total_revenue:h",
        f"""select category, n as units_sold, rev as revenue, {MEAN_CENTS("rev", "n")} as avg_price,
                   (select count(*) from {cat} b where b.rev > a.rev) + 1 as revenue_rank,
                   {PCT("rev", "(select sum(cents) from line)")} as pct_of_total_revenue
            from {cat} a order by rev desc, category limit 15""",
    )
    e["volume_below_avg_price"] = (
        "category:s units_sold:i avg_item_price:h",
        f"""select category, n as units_sold, {MEAN_CENTS("rev", "n")} as avg_item_price
            from {cat} a
            where n >= 500 and cast(rev as hugeint) * (select count(*) from line)
                             < (select sum(cents) from line) * n""",
    )
    e["price_bands"] = (
        "price_band:s items:i revenue:h avg_freight:h",
        f"""select {_band_sql(th["price_bands"]["limits"])} as price_band, count(*) as items,
                   sum(cents) as revenue, {MEAN_CENTS("sum(fcents)", "count(*)")} as avg_freight
            from line group by 1""",
    )
    e["category_delivery_quality"] = (
        "category:s revenue:h avg_delivery_days:h late_pct:h avg_review:h",
        f"""select category, sum(cents) as revenue, {AVG("delivery_days")} as avg_delivery_days,
                   {LATE} as late_pct, {AVG("review_score")} as avg_review
            from line where category <> 'untranslated' group by category
            having count(*) >= {th["category_delivery_quality"]["min_lines"]}
            order by late_pct desc, category limit 20""",
    )
    e["pareto_categories"] = (
        "category:s revenue:h cumulative_pct:h",
        f"""select category, rev as revenue, {PCT("upto", "total")} as cumulative_pct
            from (select category, rev, sum(rev) over (order by rev desc, category
                           rows unbounded preceding) as upto, sum(rev) over () as total
                  from {cat} a) b
            where 5 * upto <= 4 * total or 5 * (upto - rev) <= 4 * total""",
    )
    e["kpi_top_category"] = (
        "category:s revenue:h",
        f"""select category, rev as revenue from {cat} a
            where rev = (select max(rev) from {cat} b)""",
    )

    # --- sellers ---
    e["top_sellers"] = (
        "seller_id:i seller_state:s orders:i items:i gmv:h avg_review:h gmv_rank:i",
        f"""select seller_id, seller_state, orders, items, gmv, avg_review,
                   dense_rank() over (order by gmv desc) as gmv_rank
            from (select seller_id, seller_state, count(distinct order_id) as orders,
                         count(*) as items, sum(cents) as gmv, {AVG("review_score")} as avg_review
                  from line group by 1, 2 having count(distinct order_id) >= 10) a
            order by gmv desc, seller_id limit 20""",
    )
    e["risky_sellers"] = (
        "seller_id:i seller_state:s orders:i gmv:h avg_review:h late_delivery_pct:h",
        f"""select seller_id, seller_state, count(distinct order_id) as orders, sum(cents) as gmv,
                   {AVG("review_score")} as avg_review, {LATE} as late_delivery_pct
            from line group by 1, 2
            having count(distinct order_id) >= 50 and 2 * sum(review_score) < 7 * count(review_score)
            order by gmv desc, seller_id limit 25""",
    )
    e["seller_state_contribution"] = (
        "seller_state:s sellers:i items_sold:i gmv:h",
        """select s.seller_state, count(distinct s.seller_id) as sellers,
                  count(l.order_id) as items_sold, sum(l.cents) as gmv
           from r_sellers s left join line l on l.seller_id = s.seller_id
           group by s.seller_state""",
    )
    pairs = "(select seller_id, category, sum(cents) as rev from line group by 1, 2)"
    factor = th["sellers_above_category_avg"]["factor"]
    e["sellers_above_category_avg"] = (
        "seller_id:i category:s seller_cat_revenue:h category_avg_seller_revenue:h",
        f"""select seller_id, category, rev as seller_cat_revenue,
                   {MEAN_CENTS("total", "n")} as category_avg_seller_revenue
            from (select *, sum(rev) over (partition by category) as total,
                         count(*) over (partition by category) as n from {pairs} a) b
            where cast(2 * rev * n as hugeint) > cast(2 * {factor} as hugeint) * total
            order by rev desc, seller_id, category limit 25""",
    )

    # --- customers ---
    people = """(select person, count(distinct order_id) as orders, sum(cents) as rev,
                        min(day) as first_day, max(day) as last_day from line group by 1)"""
    e["repeat_vs_one_time"] = (
        "customer_type:s customers:i pct_customers:h avg_lifetime_revenue:h total_revenue:h",
        f"""select customer_type, n as customers,
                   {PCT("n", f"(select count(*) from {people} q)")} as pct_customers,
                   {MEAN_CENTS("rev", "n")} as avg_lifetime_revenue, rev as total_revenue
            from (select if(orders = 1, 'one_time', 'repeat') as customer_type, count(*) as n,
                         sum(rev) as rev from {people} p group by 1) a""",
    )
    e["top_customers"] = (
        "customer_unique_id:i customer_state:s orders:i lifetime_value:h avg_item_price:h",
        f"""select person as customer_unique_id, customer_state,
                   count(distinct order_id) as orders, sum(cents) as lifetime_value,
                   {MEAN_CENTS("sum(cents)", "count(*)")} as avg_item_price
            from line group by 1, 2 order by lifetime_value desc, 1, 2 limit 10""",
    )
    e["customers_without_reviews"] = (
        "customers_without_reviews:i",
        """select count(distinct person) as customers_without_reviews
           from line where review_id is null""",
    )
    e["rfm_segments"] = (
        "segment:s customers:i avg_monetary:h",
        f"""select case when r > 3 and f > 3 and m > 3 then 'Champions'
                        when r > 2 and f > 2 then 'Loyal' when r > 3 and f < 3 then 'Promising'
                        when r < 3 and f > 2 then 'At Risk' else 'Others' end as segment,
                   count(*) as customers, {MEAN_CENTS("sum(rev)", "count(*)")} as avg_monetary
            from (select *, ntile(5) over (order by last_day desc, person) as r,
                         ntile(5) over (order by orders, person) as f,
                         ntile(5) over (order by rev, person) as m from {people} p) a
            group by 1""",
    )
    e["kpi_repeat_rate"] = (
        "repeat_customer_pct:h",
        f"""select {PCT("count(*) filter (orders > 1)", "count(*)")} as repeat_customer_pct
            from {people} p""",
    )
    e["repeat_by_state"] = (
        "customer_state:s customers:i repeat_pct:h",
        f"""select customer_state, count(*) as customers,
                   {PCT("count(*) filter (orders > 1)", "count(*)")} as repeat_pct
            from (select customer_state, person, count(distinct order_id) as orders
                  from line group by 1, 2) a
            group by 1 having count(*) >= {th["repeat_by_state"]["min_customers"]}""",
    )
    e["payment_mix"] = (
        "primary_payment_type:s orders:i avg_order_value:h avg_max_installments:h total_paid:h",
        f"""select primary_payment_type, count(*) as orders,
                   {MEAN_CENTS("sum(rev)", "count(*)")} as avg_order_value,
                   {AVG("max_installments")} as avg_max_installments, sum(paid) as total_paid
            from (select order_id, sum(cents) as rev from line group by 1) a
            join order_payment using (order_id) group by 1""",
    )

    # --- delivery ---
    e["delivery_summary"] = (
        "delivered_orders:i avg_delivery_days:h avg_estimated_days:h late_delivery_pct:h "
        "avg_delay_when_late:h",
        f"""select count(delivery_days) as delivered_orders,
                   {AVG("delivery_days")} as avg_delivery_days,
                   {AVG("estimated_days")} as avg_estimated_days, {LATE} as late_delivery_pct,
                   {AVG("delay_days", "is_late")} as avg_delay_when_late
            from delivery where order_status = 'delivered'""",
    )
    e["late_by_state"] = (
        "customer_state:s delivered_orders:i avg_delivery_days:h late_pct:h",
        f"""select customer_state, count(distinct order_id) as delivered_orders,
                   {AVG("delivery_days")} as avg_delivery_days, {LATE} as late_pct
            from line where order_delivered_customer_date is not null group by 1
            having count(distinct order_id) >= {th["late_by_state"]["min_orders"]}""",
    )
    rated = """(select if(is_late, 'Late', 'On Time') as flag, review_score
                from delivery join order_review using (order_id) where is_late is not null)"""
    e["late_vs_reviews"] = (
        "delivery_flag:s review_rows:i avg_score:h pct_low_scores:h",
        f"""select flag as delivery_flag, count(*) as review_rows,
                   {AVG("review_score")} as avg_score,
                   {PCT("count(*) filter (review_score < 3)", "count(*)")} as pct_low_scores
            from {rated} a group by 1""",
    )
    e["demo_late_ratings"] = (
        "status:s avg_score:h n:i",
        f"""select flag as status, {AVG("review_score")} as avg_score, count(*) as n
            from {rated} a group by 1""",
    )
    e["delivery_buckets"] = (
        "delivery_bucket:s orders:i pct:h",
        f"""select delivery_bucket, n as orders,
                   {PCT("n", "(select count(delivery_days) from delivery)")} as pct
            from (select case when delivery_days < 4 then '0-3 days'
                              when delivery_days < 8 then '4-7 days'
                              when delivery_days < 15 then '8-14 days'
                              when delivery_days < 31 then '15-30 days'
                              else '30+ days' end as delivery_bucket, count(*) as n
                  from delivery where delivery_days is not null group by 1) a""",
    )
    e["kpi_on_time"] = (
        "on_time_delivery_pct:h",
        f"""select {PCT("count(*) filter (not is_late)", "count(is_late)")}
                     as on_time_delivery_pct from delivery""",
    )

    # --- growth ---
    months = """(select *, min(m) over (partition by person) as cohort from (
                   select distinct person, order_id, date_trunc('month', day) as m from line) z)"""
    e["new_vs_returning"] = (
        "order_month:d new_customer_orders:i returning_customer_orders:i total_orders:i",
        f"""select m as order_month, count(*) filter (m = cohort) as new_customer_orders,
                   count(*) filter (m > cohort) as returning_customer_orders,
                   count(*) as total_orders from {months} a group by 1""",
    )
    e["cohort_retention"] = (
        "cohort_month:d month_number:i cohort_customers:i active_customers:i retention_pct:h",
        f"""select cohort as cohort_month, k as month_number, size as cohort_customers,
                   active as active_customers, {PCT("active", "size")} as retention_pct
            from (select *, max(active) filter (k = 0) over (partition by cohort) as size
                  from (select cohort, date_diff('month', cohort, m) as k,
                               count(distinct person) as active from {months} a group by 1, 2) b) c
            where k <= 6""",
    )
    e["repeat_90d"] = (
        "customers_with_90d_repeat:i",
        f"""select count(*) as customers_with_90d_repeat from {people} p
            where orders >= 2 and date_diff('day', first_day, last_day) <= 90""",
    )

    # --- executive and funnel ---
    e["kpi_snapshot"] = (
        "total_orders:i unique_customers:i active_sellers:i total_gmv:h total_contribution:h "
        "avg_review_score:h",
        f"""select count(distinct order_id) as total_orders,
                   count(distinct person) as unique_customers,
                   count(distinct seller_id) as active_sellers, sum(cents) as total_gmv,
                   sum(cents - fcents) as total_contribution,
                   {AVG("review_score")} as avg_review_score
            from line where order_status not in ('unavailable', 'canceled')""",
    )
    won = "(select l.mql_id, l.origin, l.mql_id in (select mql_id from r_deals) as won from r_leads l)"
    e["funnel_conversion"] = (
        "total_mqls:i closed_deals:i conversion_pct:h",
        f"""select count(*) as total_mqls, count(*) filter (won) as closed_deals,
                   {PCT("count(*) filter (won)", "count(*)")} as conversion_pct from {won} a""",
    )
    e["funnel_by_origin"] = (
        "origin:s mqls:i closed:i conversion_pct:h",
        f"""select origin, count(*) as mqls, count(*) filter (won) as closed,
                   {PCT("count(*) filter (won)", "count(*)")} as conversion_pct
            from {won} a group by 1""",
    )
    e["declared_revenue_by_type"] = (
        "business_type:s sellers_closed:i avg_positive_declared_revenue:h "
        "total_declared_revenue:h",
        f"""select ifnull(business_type, 'unknown') as business_type, count(*) as sellers_closed,
                   {MEAN_CENTS("sum(c) filter (c > 0)", "count(*) filter (c > 0)")}
                     as avg_positive_declared_revenue,
                   sum(c) as total_declared_revenue
            from (select business_type, cast(declared_monthly_revenue * 100 as bigint) as c
                  from r_deals) a group by 1""",
    )
    sold = """(select l.*, d.business_type, m.origin
               from r_deals d join r_leads m on m.mql_id = d.mql_id
               join line l on l.seller_id = d.seller_id)"""
    e["acquired_seller_gmv"] = (
        "business_type:s lead_origin:s acquired_sellers:i marketplace_orders:i marketplace_gmv:h",
        f"""select business_type, origin as lead_origin,
                   count(distinct seller_id) as acquired_sellers,
                   count(distinct order_id) as marketplace_orders, sum(cents) as marketplace_gmv
            from {sold} a group by 1, 2
            order by marketplace_gmv desc nulls last, business_type nulls first, lead_origin
            limit 30""",
    )
    e["time_to_close"] = (
        "close_speed_bucket:s deals:i",
        """select case when k < 8 then '0-7 days' when k < 31 then '8-30 days'
                       when k < 91 then '31-90 days' else '90+ days' end as close_speed_bucket,
                  count(*) as deals
           from (select date_diff('day', first_contact_date, won_date) as k
                 from r_deals join r_leads using (mql_id)) a
           where k >= 0 group by 1""",
    )
    e["acquired_delivery_quality"] = (
        "business_type:s orders:i avg_delivery_days:h late_pct:h avg_review:h",
        f"""select ifnull(business_type, 'unknown') as business_type,
                   count(distinct order_id) as orders,
                   {AVG("delivery_days")} as avg_delivery_days, {LATE} as late_pct,
                   {AVG("review_score")} as avg_review
            from {sold} a where order_delivered_customer_date is not null group by 1
            having count(distinct order_id) >= 20""",
    )
    e["origin_gmv"] = (
        "origin:s closed_sellers_in_marketplace:i attributed_gmv:h avg_review:h",
        f"""select origin, count(distinct seller_id) as closed_sellers_in_marketplace,
                   sum(cents) as attributed_gmv, {AVG("review_score")} as avg_review
            from {sold} a group by 1""",
    )
    return e



# --- sources, cleaning, integrity, star ----------------------------------------------------


def nb(x: str) -> str:
    return f"nullif(trim({x}), '')"


# The full shape of a date or timestamp literal.
LITERAL = (
    r"\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"
)


def whole(x: str, kind: str) -> str:
    """The literal if it has its kind's full shape."""
    if kind not in ("date", "timestamp"):
        return nb(x)
    return f"case when regexp_full_match({nb(x)}, '{LITERAL}') then {nb(x)} end"


def bad(x: str, kind: str) -> str:
    return f"({nb(x)} is not null and try_cast({whole(x, kind)} as {kind}) is null)"


TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(trim(customer_city)), "
    r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda y: upper(y[1]) || y[2:]), '')"
)


def _reason(*rules: tuple[str, str]) -> str:
    return "case " + " ".join(f"when {cond} then '{name}'" for name, cond in rules) + " end"


def _blank(*columns: str) -> list[tuple[str, str]]:
    return [(f"blank_{c}", f"{nb(c)} is null") for c in columns]


def _malformed(kind: str, *columns: str) -> list[tuple[str, str]]:
    return [(f"malformed_{c}", bad(c, kind)) for c in columns]


def _truth(c: str) -> str:
    return (
        f"case when lower(trim({c})) in ('1', 'yes', 't', 'true') then true "
        f"when lower(trim({c})) in ('0', 'no', 'f', 'false') then false end"
    )


def _int(c: str, name: str | None = None) -> str:
    return f"try_cast({nb(c)} as integer) as {name or c}"


def _ts(c: str) -> str:
    return f"try_cast({whole(c, 'timestamp')} as timestamp) as {c}"


def _money(c: str) -> str:
    return f"greatest(ifnull(try_cast({nb(c)} as decimal(12,2)), 0), 0) as {c}"


_SIZES = (
    "product_name_lenght product_description_lenght product_photos_qty product_weight_g "
    "product_length_cm product_height_cm product_width_cm"
).split()

# Shaped raw tables: typed columns and the first reason to refuse the row.
SHAPED: dict[str, str] = {
    "category_translation": f"""select {nb("product_category_name")} as product_category_name,
        {nb("product_category_name_english")} as product_category_name_english,
        {_reason(*_blank("product_category_name", "product_category_name_english"))} as reason
        from w_category_translation""",
    "customers": f"""select trim(customer_id) as customer_id,
        trim(customer_unique_id) as customer_unique_id, {_int("customer_zip_code_prefix")},
        {TITLE} as customer_city, upper(trim(customer_state)) as customer_state,
        {_reason(*_blank("customer_id"), *_malformed("integer", "customer_zip_code_prefix"),
                 ("too_long_customer_state", "length(trim(customer_state)) > 2"))} as reason
        from w_customers""",
    "sellers": f"""select trim(seller_id) as seller_id, {_int("seller_zip_code_prefix")},
        lower(trim(seller_city)) as seller_city, upper(trim(seller_state)) as seller_state,
        {_reason(*_blank("seller_id"), *_malformed("integer", "seller_zip_code_prefix"))} as reason
        from w_sellers""",
    "products": f"""select trim(product_id) as product_id,
        {nb("product_category_name")} as product_category_name,
        {", ".join(_int(c, c.replace("lenght", "length")) for c in _SIZES)},
        {_reason(*_blank("product_id"), *_malformed("integer", *_SIZES))} as reason
        from w_products""",
    "geolocation": f"""select {_int("geolocation_zip_code_prefix")},
        try_cast({nb("geolocation_lat")} as decimal(10,6)) as geolocation_lat,
        try_cast({nb("geolocation_lng")} as decimal(10,6)) as geolocation_lng,
        lower(trim(geolocation_city)) as geolocation_city,
        upper(trim(geolocation_state)) as geolocation_state,
        {_reason(*_blank("geolocation_zip_code_prefix"),
                 *_malformed("decimal(10,6)", "geolocation_lat", "geolocation_lng"))} as reason
        from w_geolocation""",
    "orders": f"""select trim(order_id) as order_id, trim(customer_id) as customer_id,
        lower(trim(order_status)) as order_status, {_ts("order_purchase_timestamp")},
        {_ts("order_approved_at")}, {_ts("order_delivered_carrier_date")},
        {_ts("order_delivered_customer_date")}, {_ts("order_estimated_delivery_date")},
        {_reason(*_blank("order_id", "customer_id", "order_purchase_timestamp"),
                 *_malformed("timestamp", "order_approved_at"))} as reason
        from w_orders""",
    "order_items": f"""select trim(order_id) as order_id, {_int("order_item_id")},
        trim(product_id) as product_id, trim(seller_id) as seller_id,
        {_ts("shipping_limit_date")}, {_money("price")}, {_money("freight_value")},
        {_reason(*_malformed("integer", "order_item_id"),
                 *_malformed("decimal(12,2)", "price"))} as reason
        from w_order_items""",
    "order_payments": f"""select trim(order_id) as order_id, {_int("payment_sequential")},
        lower(trim(payment_type)) as payment_type,
        ifnull(try_cast({nb("payment_installments")} as integer), 0) as payment_installments,
        {_money("payment_value")},
        {_reason(*_malformed("integer", "payment_installments"),
                 ("out_of_domain_payment_installments",
                  f"try_cast({nb('payment_installments')} as integer) < 0"))} as reason
        from w_order_payments""",
    "order_reviews": f"""select trim(review_id) as review_id, trim(order_id) as order_id,
        case when try_cast({nb("review_score")} as integer) > 5 then 5
             when try_cast({nb("review_score")} as integer) < 1 then 1
             else try_cast({nb("review_score")} as integer) end as review_score,
        {nb("review_comment_title")} as review_comment_title,
        {nb("review_comment_message")} as review_comment_message,
        {_ts("review_creation_date")}, {_ts("review_answer_timestamp")},
        {_reason(*_blank("review_id", "review_score"))} as reason
        from w_order_reviews""",
    "qualified_leads": f"""select trim(mql_id) as mql_id,
        try_cast({whole("first_contact_date", "date")} as date) as first_contact_date,
        {nb("landing_page_id")} as landing_page_id,
        ifnull(nullif(lower(trim(origin)), ''), 'unknown') as origin,
        {_reason(*_blank("mql_id", "first_contact_date"),
                 *_malformed("date", "first_contact_date"))} as reason
        from w_qualified_leads""",
    "closed_deals": f"""select trim(mql_id) as mql_id, {nb("seller_id")} as seller_id,
        {nb("sdr_id")} as sdr_id, {nb("sr_id")} as sr_id,
        try_cast({whole("won_date", "date")} as date) as won_date,
        {nb("business_segment")} as business_segment, {nb("lead_type")} as lead_type,
        {nb("lead_behaviour_profile")} as lead_behaviour_profile,
        {_truth("has_company")} as has_company, {_truth("has_gtin")} as has_gtin,
        {nb("average_stock")} as average_stock, {nb("business_type")} as business_type,
        try_cast({nb("declared_product_catalog_size")} as decimal(12,2))
          as declared_product_catalog_size,
        try_cast({nb("declared_monthly_revenue")} as decimal(14,2)) as declared_monthly_revenue,
        {_reason(*_blank("won_date"), *_malformed("date", "won_date"),
                 *_malformed("decimal(14,2)", "declared_monthly_revenue"))} as reason
        from w_closed_deals""",
}

PARENTS = {
    "orders": (("customer_id", "customers"),),
    "order_items": (("order_id", "orders"), ("product_id", "products"), ("seller_id", "sellers")),
    "order_payments": (("order_id", "orders"),),
    "order_reviews": (("order_id", "orders"),),
    "closed_deals": (("mql_id", "qualified_leads"),),
}

CLEAN_COLUMNS = {
    "category_translation": "product_category_name:s product_category_name_english:s",
    "customers": "customer_id:s customer_unique_id:s customer_zip_code_prefix:i "
    "customer_city:s customer_state:s",
    "sellers": "seller_id:s seller_zip_code_prefix:i seller_city:s seller_state:s",
    "products": "product_id:s product_category_name:s product_name_length:i "
    "product_description_length:i product_photos_qty:i product_weight_g:i product_length_cm:i "
    "product_height_cm:i product_width_cm:i",
    "geolocation": "geolocation_zip_code_prefix:i geolocation_lat:f geolocation_lng:f "
    "geolocation_city:s geolocation_state:s",
    "orders": "order_id:s customer_id:s order_status:s order_purchase_timestamp:t "
    "order_approved_at:t order_delivered_carrier_date:t order_delivered_customer_date:t "
    "order_estimated_delivery_date:t",
    "order_items": "order_id:s order_item_id:i product_id:s seller_id:s shipping_limit_date:t "
    "price:f freight_value:f",
    "order_payments": "order_id:s payment_sequential:i payment_type:s payment_installments:i "
    "payment_value:f",
    "order_reviews": "review_id:s order_id:s review_score:i review_comment_title:s "
    "review_comment_message:s review_creation_date:t review_answer_timestamp:t",
    "qualified_leads": "mql_id:s first_contact_date:d landing_page_id:s origin:s",
    "closed_deals": "mql_id:s seller_id:s sdr_id:s sr_id:s won_date:d business_segment:s "
    "lead_type:s lead_behaviour_profile:s has_company:b has_gtin:b average_stock:s "
    "business_type:s declared_product_catalog_size:f declared_monthly_revenue:f",
}
CLEAN_QUERY = {
    "clean_categories": "category_translation",
    "clean_customers": "customers",
    "clean_sellers": "sellers",
    "clean_products": "products",
    "clean_geolocation": "geolocation",
    "clean_orders": "orders",
    "clean_order_items": "order_items",
    "clean_payments": "order_payments",
    "clean_reviews": "order_reviews",
    "clean_leads": "qualified_leads",
    "clean_deals": "closed_deals",
}


def _known(key: str, parent: str) -> str:
    kept = " and ".join(["reason is null", *(_known(k, p) for k, p in PARENTS.get(parent, ()))])
    return f"{key} in (select {key} from ({SHAPED[parent]}) p where {kept})"


def _clean_body(table: str) -> str:
    known = [_known(k, p) for k, p in PARENTS.get(table, ())]
    kept = " and ".join(["reason is null", *known])
    body = f"select distinct * exclude (reason) from ({SHAPED[table]}) s where {kept}"
    if table == "order_reviews":
        return f"""{body} qualify row_number() over (partition by review_id
                   order by review_creation_date desc nulls last, order_id) = 1"""
    return body if table == "category_translation" else body.replace("select distinct", "select")


def _why(table: str) -> str:
    cases = ["when reason is not null then reason"]
    cases += [
        f"when not {_known(k, p)} then 'orphan_{p}'" for k, p in PARENTS.get(table, ())
    ]
    return f"case {' '.join(cases)} end"


def _why_rows(table: str, columns: str) -> str:
    """The shaped rows with the reason why they are refused, if any, and the given columns."""
    rows = f"select *, {_why(table)} as why from ({SHAPED[table]}) s"
    if table == "order_reviews":
        rows = f"""select * exclude (why), case when why is not null then why
                          when row_number() over (partition by review_id, why is null
                               order by review_creation_date desc nulls last, order_id) > 1
                          then 'superseded_review_id' end as why
                   from ({rows}) y"""
    return f"select {columns}why from ({rows}) x"


# The first raw column of each table, by which a refused raw row is recognised.
FIRST_COLUMN = {t: CLEAN_COLUMNS[t].split(":")[0] for t in CLEAN_COLUMNS}


def _refused_keys(table: str) -> str:
    key = FIRST_COLUMN[table]
    shaped = re.sub(r"^select ", f"select {key} as raw_key, ", SHAPED[table], count=1)
    rows = _why_rows(table, "raw_key, ").replace(SHAPED[table], shaped, 1)
    return f"""select '{table}' as table_name, why as reason, raw_key, count(*) as n
               from ({rows}) x
               where why is not null group by 2, 3"""


def _refused_body(table: str) -> str:
    return f"""select '{table}' as table_name, why as reason, count(*) as n
               from ({_why_rows(table, "")}) x
               where why is not null group by 2"""


def _sk(*key: str) -> str:
    text = " || '|' || ".join(f"cast({k} as varchar)" for k in key)
    return f"row_number() over (order by substr(md5({text}), 1, 4), {', '.join(key)})"


STAR_BODIES: dict[str, tuple[str, str]] = {
    "build_dim_date": (
        "date_key:i full_date:d day_of_week:i day_name:s day_of_month:i week_of_year:i "
        "month_number:i month_name:s quarter:i year_number:i is_weekend:b",
        """select strftime(x, '%Y%m%d') as date_key, x as full_date, isodow(x) as day_of_week,
                  strftime(x, '%a') as day_name, day(x) as day_of_month, weekofyear(x) as week_of_year,
                  month(x) as month_number, strftime(x, '%b') as month_name, quarter(x) as quarter,
                  year(x) as year_number, isodow(x) > 5 as is_weekend
           from (select unnest(generate_series(min(day), max(day), interval 1 day)) as x
                 from delivery) a""",
    ),
    "build_dim_customer": (
        "customer_sk:i customer_id:i customer_unique_id:i customer_city:s customer_state:s "
        "customer_zip_prefix:i",
        f"""select {_sk("customer_id")} as customer_sk, *,
                   customer_zip_code_prefix as customer_zip_prefix from r_customers""",
    ),
    "build_dim_product": (
        "product_sk:i product_id:i product_category_name:s product_category_name_english:s "
        "product_weight_g:i product_photos_qty:i",
        f"""select {_sk("product_id")} as product_sk, p.* exclude (product_category_name),
                   p.product_category_name,
                   ifnull(t.product_category_name_english, 'untranslated')
                     as product_category_name_english
            from r_products p left join r_translation t
              on t.product_category_name = p.product_category_name""",
    ),
    "build_dim_seller": (
        "seller_sk:i seller_id:i seller_city:s seller_state:s seller_zip_prefix:i",
        f"""select {_sk("seller_id")} as seller_sk, *,
                   seller_zip_code_prefix as seller_zip_prefix from r_sellers""",
    ),
    "build_dim_order": (
        "order_sk:i order_id:i order_status:s order_purchase_timestamp:t order_approved_at:t "
        "order_delivered_carrier_date:t order_delivered_customer_date:t "
        "order_estimated_delivery_date:t delivery_days:i estimated_delivery_days:i "
        "is_late_delivery:b delay_days:i",
        f"""select {_sk("order_id")} as order_sk, *, estimated_days as estimated_delivery_days,
                   is_late as is_late_delivery from delivery""",
    ),
    "build_dim_payment": (
        "payment_sk:i order_id:i primary_payment_type:s payment_count:i total_payment_value:h "
        "max_installments:i",
        f"""select {_sk("order_id")} as payment_sk, *, paid as total_payment_value
            from order_payment""",
    ),
    "build_dim_review": (
        "review_sk:i order_id:i review_id:i review_score:i review_creation_date:t has_comment:b",
        f"""select {_sk("order_id")} as review_sk, *,
                   review_comment_message is not null as has_comment from order_review""",
    ),
    "build_fact_order_items": (
        "fact_sk:i order_id:i order_item_id:i date_key:i customer_sk:i product_sk:i seller_sk:i "
        "order_sk:i payment_sk:i review_sk:i price:f freight_value:f item_revenue:f "
        "item_contribution:f shipping_limit_date:t",
        f"""select {_sk("l.order_id", "l.order_item_id")} as fact_sk, l.order_id, l.order_item_id,
                   strftime(l.day, '%Y%m%d') as date_key, c.sk as customer_sk, p.sk as product_sk,
                   s.sk as seller_sk, o.sk as order_sk, y.sk as payment_sk, v.sk as review_sk,
                   l.price, l.freight_value, l.price as item_revenue,
                   l.price - l.freight_value as item_contribution, l.shipping_limit_date
            from line l
            join (select customer_id, {_sk("customer_id")} as sk from r_customers) c
              on c.customer_id = l.customer_id
            join (select product_id, {_sk("product_id")} as sk from r_products) p
              on p.product_id = l.product_id
            join (select seller_id, {_sk("seller_id")} as sk from r_sellers) s
              on s.seller_id = l.seller_id
            join (select order_id, {_sk("order_id")} as sk from r_orders) o
              on o.order_id = l.order_id
            left join (select order_id, {_sk("order_id")} as sk from order_payment) y
              on y.order_id = l.order_id
            left join (select order_id, {_sk("order_id")} as sk from order_review) v
              on v.order_id = l.order_id""",
    ),
    "assign_surrogate_keys": (
        "payment_row:i order_id:i payment_sequential:i",
        f"""select {_sk("order_id", "payment_sequential")} as payment_row, order_id,
                   payment_sequential from r_payments""",
    ),
}

# Tables the integrity checks read, by contract name.
X_TABLES = {
    "customers": "x_customers",
    "sellers": "x_sellers",
    "category_translation": "r_translation",
    "products": "x_products",
    "orders": "x_orders",
    "order_items": "x_items",
    "order_payments": "x_payments",
    "order_reviews": "x_reviews",
    "qualified_leads": "x_leads",
    "closed_deals": "x_deals",
}
X_KEYS = {
    "customers": "customer_id",
    "sellers": "seller_id",
    "category_translation": "product_category_name",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_id, order_item_id",
    "order_payments": "order_id, payment_sequential",
    "order_reviews": "review_id",
    "qualified_leads": "mql_id",
    "closed_deals": "mql_id",
}
X_REFERENCES = (
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
    ("order_payments", "orders", "order_id"),
    ("order_reviews", "orders", "order_id"),
    ("closed_deals", "qualified_leads", "mql_id"),
)
X_REQUIRED = {
    "customers": "customer_id customer_unique_id",
    "sellers": "seller_id",
    "category_translation": "product_category_name product_category_name_english",
    "products": "product_id",
    "orders": "order_id customer_id order_status order_purchase_timestamp",
    "order_items": "order_id order_item_id product_id seller_id price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_value",
    "order_reviews": "review_id order_id review_score",
    "qualified_leads": "mql_id first_contact_date",
    "closed_deals": "mql_id won_date",
}
STAR_SOURCES = {
    "dim_date": "(select distinct day from delivery)",
    "dim_customer": "r_customers",
    "dim_product": "r_products",
    "dim_seller": "r_sellers",
    "dim_order": "r_orders",
    "dim_payment": "order_payment",
    "dim_review": "order_review",
    "fact_order_items": "line",
}
DAY_COUNT = "(select date_diff('day', min(day), max(day)) + 1 from delivery)"


def _union(parts) -> str:
    return "\nunion all ".join(parts)


def _no_parent(child: str, parent: str, key: str) -> str:
    return f"""{child} c where c.{key} is not null
               and not exists (select 1 from {parent} p where p.{key} = c.{key})"""


def _star_count(name: str) -> str:
    if name == "dim_date":
        return f"select '{name}' as table_name, {DAY_COUNT} as n"
    return f"select '{name}' as table_name, count(*) as n from {STAR_SOURCES[name]}"


def operator_entries() -> dict[str, tuple[str, str]]:
    e: dict[str, tuple[str, str]] = {}
    raw_columns = {
        t: [f.source for f in contract.fields] for t, contract in CONTRACTS.items()
    }
    e["load_staging_csv"] = (
        "table_name:s n:i characters:i",
        _union(
            f"""select '{t}' as table_name, count(*) as n,
                       sum({" + ".join(f"ifnull(length({c}), 0)" for c in columns)}) as characters
                from w_{t}"""
            for t, columns in raw_columns.items()
        ),
    )
    e["load_inferred_csv"] = (
        "order_id:i order_item_id:i product_id:i seller_id:i shipping_limit_date:t price:f "
        "freight_value:f",
        "select * from r_items",
    )
    e["load_inferred_tables"] = (
        "table_name:s column_name:s type:s n:i",
        _union(
            f"""select '{t}' as table_name, '{f.source}' as column_name, case
                  when count(v) = 0 then 'string'
                  when bool_and(regexp_full_match(v, '[+-]?[0-9]+')
                                and try_cast(v as bigint) is not null)
                    then case when bool_and(try_cast(v as integer) is not null) then 'int' else 'bigint' end
                  when bool_and(try_cast(v as double) is not null and regexp_matches(v, '[0-9]')
                                and (contains(v, '.') or try_cast(v as bigint) is not null)
                                and not contains(v, ' ')) then 'double'
                  when bool_and(length(v) <= 10 and try_cast(v as date) is not null) then 'date'
                  when bool_and(contains(v, '-') and trim(v) = v
                                and try_cast(v as timestamp) is not null) then 'timestamp_ntz'
                  when bool_and(lower(v) in ('true', 'false')) then 'boolean'
                  else 'string' end as type, count(v) as n
                from (select nullif(cast({f.source} as varchar), '') as v from w_{t}) x
                where v is not null"""
            for t in CONTRACTS
            if t != "geolocation"
            for f in CONTRACTS[t].fields
        ),
    )
    e["normalize_headers"] = (
        "product_id:s product_category_name:s " + " ".join(f"{c}:s" for c in _SIZES),
        "select * from w_products",
    )
    source = {t: r for r, t in PATH_TABLES.items()} | {"order_reviews": "reviews"}
    e["overwrite_layer"] = (
        "table_name:s n:i",
        _union(f"select '{t}' as table_name, count(*) as n from {s}" for t, s in source.items()),
    )
    e["materialize_table"] = (
        "purchase_month:s order_status:s n:i",
        """select strftime(day, '%Y-%m') as purchase_month, order_status, count(*) as n
           from delivery group by 1, 2""",
    )
    e["staging_row_counts"] = (
        "t:s n:i",
        _union(
            f"select '{t}' as t, count(*) as n from w_{s}"
            for t, s in (
                ("customers", "customers"),
                ("orders", "orders"),
                ("order_items", "order_items"),
                ("mqls", "qualified_leads"),
                ("closed_deals", "closed_deals"),
            )
        ),
    )
    e["cleaned_row_counts"] = (
        "entity:s count:i",
        _union(
            f"select '{t}' as entity, count(*) as count from {s}"
            for t, s in (
                ("customers", "r_customers"),
                ("orders", "r_orders"),
                ("order_items", "r_items"),
                ("products", "r_products"),
                ("sellers", "r_sellers"),
                ("payments", "r_payments"),
                ("reviews", "reviews"),
                ("mqls", "r_leads"),
                ("closed_deals", "r_deals"),
            )
        ),
    )
    e["star_row_counts"] = ("table_name:s n:i", _union(_star_count(n) for n in STAR_SOURCES))
    e["publish_bi_tables"] = (
        "table_name:s n:i",
        _union(
            [
                *(_star_count(n) for n in STAR_SOURCES),
                "select 'qualified_leads' as table_name, count(*) as n from r_leads",
                "select 'closed_deals' as table_name, count(*) as n from r_deals",
            ]
        ),
    )
    suite = metric_entries(DEFAULT_THRESHOLDS)
    e["run_metric_suite"] = (
        "metric:s status:s row_count:i",
        _union(
            f"select '{n}' as metric, 'ok' as status, count(*) as row_count from ({body}) x"
            for n, (_, body) in suite.items()
        ),
    )
    kpi, top = suite["kpi_snapshot"][1], suite["top_categories"][1]
    e["export_insights"] = (
        "total_orders:i unique_customers:i active_sellers:i total_gmv:h avg_review_score:h "
        "repeat_customer_pct:h conversion_pct:h on_time_delivery_pct:h late_n:i top_revenue:h",
        f"""select k.*, r.*, f.conversion_pct, o.*,
                   (select n from ({suite["demo_late_ratings"][1]}) z where status = 'Late')
                     as late_n,
                   (select sum(revenue) from (select revenue from ({top}) y
                    order by revenue desc, category limit 5) w) as top_revenue
            from ({kpi}) k, ({suite["kpi_repeat_rate"][1]}) r, ({suite["funnel_conversion"][1]}) f,
                 ({suite["kpi_on_time"][1]}) o""",
    )
    e["insight_snapshot"] = (
        "total_orders:i unique_customers:i active_sellers:i total_gmv:h avg_review_score:h",
        kpi,
    )
    e["insight_late_reviews"] = suite["demo_late_ratings"]
    e["insight_repeat_rate"] = suite["kpi_repeat_rate"]
    e["insight_top_categories"] = (
        "category:s revenue:h",
        f"select category, revenue from ({top}) y order by revenue desc, category limit 5",
    )
    e["insight_funnel"] = suite["funnel_conversion"]
    e["insight_on_time"] = suite["kpi_on_time"]

    for query, table in CLEAN_QUERY.items():
        e[query] = (CLEAN_COLUMNS[table], _clean_body(table))
    e["normalize_boolean"] = (
        "mql_id:s has_company:b has_gtin:b",
        f"""select mql_id, {_truth("has_company")} as has_company, {_truth("has_gtin")} as has_gtin
            from w_closed_deals""",
    )
    e["quarantine_rejects"] = (
        "table_name:s reason:s n:i",
        _union(_refused_body(t) for t in SHAPED),
    )

    e["check_primary_keys"] = (
        "table_name:s violations:i",
        _union(
            f"""select '{t}' as table_name, count(*) as violations from (
                  select {X_KEYS[t]} from {s} group by {X_KEYS[t]}
                  having count(*) > 1 or {" or ".join(k + " is null"
                                                      for k in X_KEYS[t].split(", "))}) x"""
            for t, s in X_TABLES.items()
        ),
    )
    e["check_foreign_keys"] = (
        "table_name:s reference:s violations:i",
        _union(
            f"""select '{c}' as table_name, '{p}' as reference, count(*) as violations
                from {_no_parent(X_TABLES[c], X_TABLES[p], k)}"""
            for c, p, k in X_REFERENCES
        )
        + "\nunion all "
        + _union(
            f"""select 'fact_order_items', '{dim}', count(*) from line l
                where {key} is not null and {key} not in (select {key} from {table})"""
            for dim, key, table in (
                ("dim_date", "day", "delivery"),
                ("dim_customer", "customer_id", "r_customers"),
                ("dim_product", "product_id", "r_products"),
                ("dim_seller", "seller_id", "r_sellers"),
                ("dim_order", "order_id", "r_orders"),
                ("dim_payment", "order_id", "(select order_id from line) q"),
                ("dim_review", "review_id", "order_review"),
            )
        ),
    )
    e["check_domains"] = (
        "table_name:s column_name:s violations:i",
        _union(
            f"""select '{t}' as table_name, '{c}' as column_name, count(*) as violations
                from {X_TABLES[t]} where {rule}"""
            for t, c, rule in (
                ("order_items", "price", "price < 0"),
                ("order_items", "freight_value", "freight_value < 0"),
                ("order_payments", "payment_installments", "payment_installments < 0"),
                ("order_payments", "payment_value", "payment_value < 0"),
                ("order_reviews", "review_score", "review_score not in (1, 2, 3, 4, 5)"),
            )
        ),
    )
    e["check_unique"] = (
        "table_name:s key:s violations:i",
        _union(
            f"""select '{t}' as table_name, '{k.replace(" ", "")}' as key, count(*) as violations
                from (select {k} from {s} group by {k} having count(*) > 1) x"""
            for t, k, s in (
                ("dim_customer", "customer_id", "r_customers"),
                ("dim_product", "product_id", "r_products"),
                ("dim_seller", "seller_id", "r_sellers"),
                ("dim_order", "order_id", "r_orders"),
                ("dim_payment", "order_id", "order_payment"),
                ("dim_review", "order_id", "order_review"),
                ("fact_order_items", "order_id, order_item_id", "x_items"),
            )
        )
        + "\nunion all select 'dim_date', 'full_date', count(*) from (select day from "
        "(select distinct day from delivery) d group by day having count(*) > 1) x",
    )
    e["check_not_null"] = (
        "table_name:s column_name:s violations:i",
        _union(
            f"""select '{t}' as table_name, '{c}' as column_name,
                       count(*) - count({c}) as violations from {X_TABLES[t]}"""
            for t, columns in X_REQUIRED.items()
            for c in columns.split()
        ),
    )
    limits = [
        (t, c, f"length(trim({c})) > {n}")
        for t, columns in {
            "category_translation": "product_category_name=100 product_category_name_english=100",
            "customers": "customer_id=50 customer_unique_id=50 customer_city=100 customer_state=2",
            "sellers": "seller_id=50 seller_city=100 seller_state=2",
            "products": "product_id=50 product_category_name=100",
            "geolocation": "geolocation_city=100 geolocation_state=2",
            "orders": "order_id=50 customer_id=50 order_status=30",
            "order_items": "order_id=50 product_id=50 seller_id=50",
            "order_payments": "order_id=50 payment_type=30",
            "order_reviews": "review_id=50 order_id=50 review_comment_title=255",
            "qualified_leads": "mql_id=50 landing_page_id=50 origin=50",
            "closed_deals": "mql_id=50 seller_id=50 sdr_id=50 sr_id=50 business_segment=100 "
            "lead_type=50 lead_behaviour_profile=50 average_stock=50 business_type=50",
        }.items()
        for c, n in (pair.split("=") for pair in columns.split())
    ]
    limits += [
        ("geolocation", "geolocation_lat", bad("geolocation_lat", "decimal(10,6)")),
        ("geolocation", "geolocation_lng", bad("geolocation_lng", "decimal(10,6)")),
        ("order_items", "price", bad("price", "decimal(12,2)")),
        ("order_items", "freight_value", bad("freight_value", "decimal(12,2)")),
        ("order_payments", "payment_value", bad("payment_value", "decimal(12,2)")),
        (
            "closed_deals",
            "declared_product_catalog_size",
            bad("declared_product_catalog_size", "decimal(12,2)"),
        ),
        (
            "closed_deals",
            "declared_monthly_revenue",
            bad("declared_monthly_revenue", "decimal(14,2)"),
        ),
    ]
    e["check_type_bounds"] = (
        "table_name:s column_name:s violations:i",
        _union(
            f"""select '{t}' as table_name, '{c}' as column_name, count(*) as violations
                from w_{t} where {rule}"""
            for t, c, rule in limits
        ),
    )
    e.update(STAR_BODIES)
    return e


# Whole-path queries: the same SQL over what the cleaning of the dirty text leaves.
PATH_TABLES = {
    "r_customers": "customers",
    "r_sellers": "sellers",
    "r_translation": "category_translation",
    "r_products": "products",
    "r_orders": "orders",
    "r_items": "order_items",
    "r_payments": "order_payments",
    "r_reviews_all": "order_reviews",
    "r_leads": "qualified_leads",
    "r_deals": "closed_deals",
}
PATH_METRICS = ("yearly_gmv", "monthly_gmv", "kpi_snapshot", "delivery_summary", "payment_mix", "late_vs_reviews")


def path_entries() -> dict[str, tuple[str, str]]:
    """pipeline_*: counts and metrics from dirty text through cleaning and star."""
    e = {f"pipeline_{n}": metric_entries(DEFAULT_THRESHOLDS)[n] for n in PATH_METRICS}
    e["pipeline_counts"] = (
        "table_name:s n:i",
        _union(
            f"select '{t}' as table_name, count(*) as n from {r}"
            for r, t in (*PATH_TABLES.items(), ("line", "fact_order_items"))
        ),
    )
    e["pipeline_quarantine"] = (
        "table_name:s reason:s raw_key:s n:i",
        _union(_refused_keys(t) for t in SHAPED),
    )
    return e


def finish_path(columns: str, body: str) -> str:
    """Full statement over the cleaned text: p_* tables stand in for the r_* roles."""
    shown = [c.split(":") for c in columns.split()]
    casts = ", ".join(_CASTS[kind].format(c=f'"{c}"') + f' as "{c}"' for c, kind in shown)
    tables = ",\n".join(f"p_{r[2:]} as ({_clean_body(t)})" for r, t in PATH_TABLES.items())
    rest = f"{SHARED}, body as ({body})\nselect {casts} from body"
    for role in PATH_TABLES:
        rest = re.sub(rf"\b{role}\b", f"p_{role[2:]}", rest)
    return f"with {duckdb_ctes()},\n{tables},{rest}"


def all_entries() -> dict[str, tuple[str, str]]:
    entries = operator_entries()
    for name, (columns, body) in metric_entries(TEST_THRESHOLDS).items():
        entries[name] = (columns, on_broken_tables(body) if name in BROKEN_CHECKS else body)
    return entries


def oracle_sql() -> dict[str, str]:
    direct = {name: finish(columns, body) for name, (columns, body) in all_entries().items()}
    return direct | {name: finish_path(*entry) for name, entry in path_entries().items()}


def finish(columns: str, body: str) -> str:
    """Full statement: role CTEs, shared CTEs, body, output types."""
    shown = [c.split(":") for c in columns.split()]
    casts = ", ".join(_CASTS[kind].format(c=f'"{c}"') + f' as "{c}"' for c, kind in shown)
    return f"with {duckdb_ctes()},{SHARED}, body as ({body})\nselect {casts} from body"
