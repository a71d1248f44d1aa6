"""Marketplace roles and dirty raw text, derived from the driver's tables.

The text below is read by both Spark and DuckDB: integer arithmetic on keys only.  `{ts}`
is the engine's name of the zone-less timestamp.  `r_*` are typed, clean tables, `w_*` are
all-text raw tables with planted blanks, bad literals, orphans and copies, `x_*` are typed
tables that break keys and references on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("orders", "lineitem", "part", "customer", "supplier", "nation", "events")

ROLES: dict[str, str] = {}

ROLES["r_orders"] = """
select order_id, order_id as customer_id, o_custkey, o_totalprice, order_status,
       purchase as order_purchase_timestamp,
       case when order_id % 50 = 0 then null
            else purchase + interval '1' hour * (order_id % 40 - 2) end as order_approved_at,
       purchase + interval '1' day * (1 + order_id % 6) as order_delivered_carrier_date,
       case when (order_status = 'delivered' and order_id % 97 <> 0)
              or (order_status = 'canceled' and order_id % 31 = 0)
            then purchase + interval '1' day * ((order_id * 7) % 41) end
         as order_delivered_customer_date,
       case when order_id % 101 = 0 then null
            else cast(cast(purchase as date) as {ts}) + interval '1' day * (15 + order_id % 20) end
         as order_estimated_delivery_date
from (
  select o_orderkey as order_id, o_custkey, o_totalprice,
         case when o_orderstatus = 'F' then 'delivered'
              when o_orderstatus = 'O' and o_orderkey % 7 = 0 then 'unavailable'
              when o_orderstatus = 'O' then 'shipped'
              when o_orderkey % 3 = 0 then 'canceled'
              else 'delivered' end as order_status,
         o_orderdate + interval '1' hour * (o_orderkey % 24) as purchase
  from orders) o"""

ROLES["r_customers"] = """
select o_orderkey as customer_id, o_custkey * 8 + o_orderkey % 8 as customer_unique_id,
       cast(o_custkey % 9973 as int) as customer_zip_code_prefix,
       'City ' || cast(o_custkey % 211 as string) as customer_city, n_name as customer_state
from orders
join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey"""

# A tenth more sellers than suppliers: those have no lines.
ROLES["r_sellers"] = """
select seller_id, cast(seller_id % 9973 as int) as seller_zip_code_prefix,
       'city ' || cast(seller_id % 17 as string) as seller_city, n_name as seller_state
from (
  select s_suppkey as seller_id, s_nationkey from supplier
  union all
  select s_suppkey + 1000000 as seller_id, s_nationkey from supplier where s_suppkey % 10 = 0) s
join nation on n_nationkey = s_nationkey"""

ROLES["r_translation"] = """
select distinct p_brand as product_category_name,
       'en_' || lower(replace(p_brand, '#', '_')) as product_category_name_english
from part
where p_brand not in ('Brand#7', 'Brand#13')"""

ROLES["r_products"] = """
select p_partkey as product_id,
       case when p_partkey % 61 = 0 then null else p_brand end as product_category_name,
       cast(p_partkey % 60 as int) as product_name_length,
       cast(p_partkey % 900 as int) as product_description_length,
       cast(p_partkey % 6 as int) as product_photos_qty,
       cast(p_size * 100 as int) as product_weight_g,
       cast(p_size as int) as product_length_cm,
       cast(p_size + 1 as int) as product_height_cm,
       cast(p_size + 2 as int) as product_width_cm
from part"""

ROLES["r_items"] = """
select l_orderkey as order_id,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
            l_suppkey, l_extendedprice, l_shipdate, l_quantity) as int) as order_item_id,
       l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
       cast(l_extendedprice as decimal(12,2)) as price,
       cast(cast(l_quantity as decimal(12,2)) * 100 as decimal(12,2)) as freight_value
from lineitem"""

ROLES["r_payments"] = """
select o_orderkey as order_id, cast(seq as int) as payment_sequential,
       case (o_orderkey + seq) % 4 when 0 then 'credit_card' when 1 then 'slip'
            when 2 then 'voucher' else 'debit_card' end as payment_type,
       cast((o_orderkey * seq) % 12 as int) as payment_installments,
       cast(cast(o_totalprice as decimal(14,2)) * seq as decimal(14,2)) as payment_value
from (select o_orderkey, o_totalprice, 1 as seq from orders
      union all select o_orderkey, o_totalprice, 2 from orders
      union all select o_orderkey, o_totalprice, 3 from orders) p
where seq <= 1 + o_orderkey % 3 and o_orderkey % 89 <> 0"""

# Before de-duplication by review_id.
ROLES["r_reviews_all"] = """
select case when order_id % 53 = 0 then order_id - 1 else order_id end as review_id, order_id,
       cast(case when order_delivered_customer_date > order_estimated_delivery_date
            then 1 + order_id % 3 else 3 + order_id % 3 end as smallint) as review_score,
       cast(null as string) as review_comment_title,
       case when order_id % 2 = 0 then 'c' end as review_comment_message,
       order_purchase_timestamp + interval '1' day * (order_id % 30) as review_creation_date,
       order_purchase_timestamp + interval '1' day * (order_id % 30 + 2) as review_answer_timestamp
from ({r_orders}) o
where order_id % 11 <> 0"""

ROLES["r_leads"] = """
select event_id as mql_id, cast(ts as date) as first_contact_date,
       cast(event_id % 40 as string) as landing_page_id,
       case when user_id % 8 = 0 then 'unknown'
            else 'origin_' || cast(user_id % 8 as string) end as origin
from events where event_type = 'signup'"""

ROLES["r_deals"] = """
select event_id as mql_id,
       case when event_id % 13 = 0 then null else (event_id * 37) % 130 end as seller_id,
       cast(cast(cast(ts as date) as {ts}) + interval '1' day * ((event_id * 31) % 125 - 4)
            as date) as won_date,
       case when event_id % 5 = 0 then null
            else 'biz_' || cast(event_id % 5 as string) end as business_type,
       case when event_id % 4 = 0 then null
            else cast(cast(value as decimal(14,2)) * (event_id % 3) as decimal(14,2)) end
         as declared_monthly_revenue
from events where event_type = 'signup' and (event_id + user_id) % 9 = 0"""

# --- raw text -----------------------------------------------------------------------

ROLES["w_category_translation"] = """
select case when p_partkey % 3 = 0 then '  ' || p_brand || ' ' else p_brand end
         as product_category_name,
       case when p_brand in ('Brand#7', 'Brand#13') then '   '
            else ' en_' || lower(replace(p_brand, '#', '_')) end as product_category_name_english
from part"""

ROLES["w_customers"] = """
select case when o_orderkey % 211 = 0 then '  '
            when o_orderkey % 7 = 0 then ' ' || cast(o_orderkey as string) || ' '
            else cast(o_orderkey as string) end as customer_id,
       'p' || cast(o_custkey * 8 + o_orderkey % 8 as string) as customer_unique_id,
       case when o_orderkey % 10 = 0 then '' when o_orderkey % 23 = 0 then 'x9'
            else ' ' || cast(o_custkey % 9973 as string) end as customer_zip_code_prefix,
       case when o_orderkey % 13 = 0 then null
            else ' SAO ' || lower(n_name) || ' D''OESTE-norte ' end as customer_city,
       case when o_orderkey % 997 = 0 then 'abc'
            else 'n' || cast(c_nationkey % 10 as string) end as customer_state
from orders
join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey"""

ROLES["w_sellers"] = """
select case when s_suppkey % 41 = 0 then ' ' else ' ' || cast(s_suppkey as string) end
         as seller_id,
       case when s_suppkey % 9 = 0 then 'zip' else cast(s_suppkey % 9973 as string) end
         as seller_zip_code_prefix,
       ' Vila ' || upper(n_name) || ' ' as seller_city,
       ' n' || cast(s_nationkey % 10 as string) as seller_state
from supplier
join nation on n_nationkey = s_nationkey"""

ROLES["w_products"] = """
select case when p_partkey % 301 = 0 then '' else cast(p_partkey as string) || ' ' end
         as product_id,
       case when p_partkey % 61 = 0 then '  ' else ' ' || p_brand end as product_category_name,
       cast(p_partkey % 60 as string) as product_name_lenght,
       case when p_partkey % 119 = 0 then 'n/a' else cast(p_partkey % 900 as string) end
         as product_description_lenght,
       case when p_partkey % 17 = 0 then null else cast(p_partkey % 6 as string) end
         as product_photos_qty,
       cast(p_size * 100 as string) as product_weight_g,
       cast(p_size as string) as product_length_cm,
       ' ' || cast(p_size + 1 as string) || ' ' as product_height_cm,
       case when p_partkey % 5 = 0 then '' else cast(p_size + 2 as string) end as product_width_cm
from part"""

ROLES["w_geolocation"] = """
select case when c_custkey % 19 = 0 then ' ' else cast(c_custkey % 97 as string) end
         as geolocation_zip_code_prefix,
       '-23.' || cast(100000 + (c_custkey * 7) % 899999 as string) ||
         case when c_custkey % 29 = 0 then '7' else '' end as geolocation_lat,
       case when c_custkey % 101 = 0 then 'west'
            else '-46.' || cast(100000 + c_custkey % 89 as string) end as geolocation_lng,
       'São ' || upper(c_mktsegment) as geolocation_city,
       'n' || cast(c_nationkey % 10 as string) as geolocation_state
from customer"""

ROLES["w_orders"] = """
select case when order_id % 503 = 0 then ' '
            when order_id % 5 = 0 then ' ' || cast(order_id as string)
            else cast(order_id as string) end as order_id,
       case when order_id % 307 = 0 then '' else cast(customer_id as string) || ' ' end
         as customer_id,
       ' ' || upper(order_status) as order_status,
       case when order_id % 401 = 0 then ' '
            else cast(order_purchase_timestamp as string) end as order_purchase_timestamp,
       case when order_id % 301 = 0 then 'soon' when order_id % 50 = 0 then ''
            when order_id % 397 = 0 then '2018' when order_id % 409 = 0 then '2018-02'
            else cast(order_approved_at as string) end as order_approved_at,
       cast(order_delivered_carrier_date as string) as order_delivered_carrier_date,
       cast(order_delivered_customer_date as string) as order_delivered_customer_date,
       cast(order_estimated_delivery_date as string) as order_estimated_delivery_date
from ({r_orders}) o"""

ROLES["w_order_items"] = """
select case when order_id % 131 = 0 then 'none' else ' ' || cast(order_id as string) end
         as order_id,
       case when order_id % 173 = 0 then 'one' else cast(order_item_id as string) end
         as order_item_id,
       case when product_id % 251 = 0 and order_item_id = 2 then 'none'
            else cast(product_id as string) end as product_id,
       case when seller_id % 47 = 0 and order_item_id = 3 then 'none'
            else cast(seller_id as string) end as seller_id,
       case when product_id % 23 = 0 then '' else cast(shipping_limit_date as string) end
         as shipping_limit_date,
       case when product_id % 37 = 0 then '' when product_id % 31 = 0 then '-5.00'
            when product_id % 311 = 0 then 'free' else ' ' || cast(price as string) end as price,
       case when seller_id % 29 = 0 then null else cast(freight_value as string) end
         as freight_value
from ({r_items}) i"""

ROLES["w_order_payments"] = """
select case when order_id % 71 = 0 then 'none' else cast(order_id as string) || ' ' end
         as order_id,
       cast(payment_sequential as string) as payment_sequential,
       ' ' || upper(payment_type) as payment_type,
       case when order_id % 6 = 0 then '' when order_id % 337 = 0 then 'many'
            when order_id % 349 = 0 then '-3'
            else cast(payment_installments as string) end as payment_installments,
       case when order_id % 59 = 0 then '-1' when order_id % 43 = 0 then ' '
            else cast(payment_value as string) end as payment_value
from ({r_payments}) p"""

ROLES["w_order_reviews"] = """
select case when order_id % 409 = 0 then ' ' else ' r' || cast(review_id as string) end
         as review_id,
       case when order_id % 83 = 0 then 'none' else cast(order_id as string) end as order_id,
       case when order_id % 67 = 0 then '' when order_id % 19 = 0 then '9'
            when order_id % 17 = 0 then '0' else cast(review_score as string) end as review_score,
       case when order_id % 3 = 0 then '  ' when order_id % 4 = 0 then 'says "fine"' end
         as review_comment_title,
       case when order_id % 2 = 0 then 'line one' || chr(10) || 'line, "two" ' ||
            cast(order_id as string) when order_id % 5 = 0 then '' end as review_comment_message,
       case when order_id % 10 = 0 then '' else cast(review_creation_date as string) end
         as review_creation_date,
       cast(review_answer_timestamp as string) as review_answer_timestamp
from ({r_reviews_all}) r"""

ROLES["w_qualified_leads"] = """
select case when event_id % 97 = 0 then ' ' else 'm' || cast(event_id as string) end as mql_id,
       case when event_id % 89 = 0 then '' when event_id % 83 = 0 then 'today'
            when event_id % 79 = 0 then cast(cast(ts as date) as string) || ' garbage'
            when event_id % 73 = 0 then '2018' when event_id % 71 = 0 then '2018-1-2T??'
            else cast(cast(ts as date) as string) end as first_contact_date,
       case when event_id % 7 = 0 then ' ' else cast(event_id % 40 as string) end
         as landing_page_id,
       case when user_id % 8 = 0 then ' ' when user_id % 8 = 1 then null
            else ' Origin_' || cast(user_id % 8 as string) end as origin
from events where event_type = 'signup'"""

ROLES["w_closed_deals"] = """
select case when mql_id % 61 = 0 then 'none' else ' m' || cast(mql_id as string) end as mql_id,
       case when seller_id is null then ' ' else cast(seller_id as string) end as seller_id,
       's' || cast(mql_id % 5 as string) as sdr_id, '' as sr_id,
       case when mql_id % 53 = 0 then '' when mql_id % 43 = 0 then '2018-02'
            else cast(won_date as string) end as won_date,
       'seg ' || cast(mql_id % 9 as string) as business_segment,
       cast(null as string) as lead_type, ' wolf ' as lead_behaviour_profile,
       case mql_id % 6 when 0 then 'TRUE' when 1 then ' yes ' when 2 then '0' when 3 then 'No'
            when 4 then 'maybe' else null end as has_company,
       case mql_id % 4 when 0 then 'T' when 1 then '1' when 2 then 'f' else '' end as has_gtin,
       '' as average_stock, business_type,
       case when mql_id % 3 = 0 then '' else cast(mql_id % 500 as string) || '.5' end
         as declared_product_catalog_size,
       case when mql_id % 47 = 0 then 'lots' else cast(declared_monthly_revenue as string) end
         as declared_monthly_revenue
from ({r_deals}) d"""

# --- typed tables with broken keys, references and domains ------------------------------

ROLES["x_customers"] = """
select case when customer_id % 463 = 0 then null else customer_id end as customer_id,
       case when customer_id % 379 = 0 then null else customer_unique_id end
         as customer_unique_id,
       customer_zip_code_prefix, customer_city, customer_state
from ({r_customers}) c
where customer_id % 97 <> 0
union all
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
from ({r_customers}) c where customer_id % 499 = 0"""

ROLES["x_orders"] = """
select order_id, customer_id, order_status,
       case when order_id % 701 = 0 then null else order_purchase_timestamp end
         as order_purchase_timestamp,
       order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
       order_estimated_delivery_date
from ({r_orders}) o where order_id % 89 <> 0
union all
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
from ({r_orders}) o where order_id % 601 = 0"""

# The raw line number repeats within an order.
ROLES["x_items"] = """
select l_orderkey as order_id, cast(l_linenumber as int) as order_item_id,
       l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
       cast(case when l_partkey % 53 = 0 then -1 else l_extendedprice end as decimal(12,2))
         as price,
       cast(cast(l_quantity as decimal(12,2)) * 100 as decimal(12,2)) as freight_value
from lineitem"""

ROLES["x_products"] = "select * from ({r_products}) p where product_id % 103 <> 0"

ROLES["x_sellers"] = "select * from ({r_sellers}) s where seller_id % 51 <> 0"

ROLES["x_payments"] = """
select order_id, payment_sequential, payment_type,
       case when order_id % 37 = 0 then -1 when order_id % 41 = 0 then null
            else payment_installments end as payment_installments,
       case when order_id % 47 = 0 then -payment_value else payment_value end as payment_value
from ({r_payments}) p"""

ROLES["x_reviews"] = """
select review_id, order_id,
       cast(case when order_id % 29 = 0 then 0 when order_id % 31 = 0 then 6
            else review_score end as smallint) as review_score,
       review_comment_title, review_comment_message, review_creation_date,
       review_answer_timestamp
from ({r_reviews_all}) r"""

ROLES["x_leads"] = """
select * from ({r_leads}) l where mql_id % 71 <> 0
union all select * from ({r_leads}) l where mql_id % 23 = 0"""

ROLES["x_deals"] = """
select * from ({r_deals}) d
union all select * from ({r_deals}) d where mql_id % 17 = 0"""


def _expand(name: str, ts: str, nested: bool) -> str:
    """Role text with its parents as CTE names (DuckDB) or as nested queries (Spark)."""
    text = ROLES[name]
    for other in ROLES:
        mark = "({" + other + "})"
        if mark in text:
            text = text.replace(mark, f"({_expand(other, ts, True)})" if nested else other)
    return text.replace("{ts}", ts)


def duckdb_ctes() -> str:
    """All roles as one comma-separated list of CTEs."""
    return ",\n".join(f"{n} as ({_expand(n, 'timestamp', False)})" for n in ROLES)


def read_base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES}


def spark_role(base: dict[str, DataFrame], name: str) -> DataFrame:
    """One role as a lazy DataFrame over the base tables."""
    text = _expand(name, "timestamp_ntz", True)
    for table in base:
        text = _name_source(text, table)
    used = {t: df for t, df in base.items() if "{" + t + "}" in text}
    return next(iter(base.values())).sparkSession.sql(text, **used)


def _name_source(text: str, table: str) -> str:
    for word in ("from", "join"):
        for end in ("\n", " ", ")"):
            text = text.replace(f"{word} {table}{end}", f"{word} {{{table}}}{end}")
        if text.endswith(f"{word} {table}"):
            text = text[: -len(table)] + "{" + table + "}"
    return text
