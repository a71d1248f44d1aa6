"""Declared shape of every table: columns, types, limits, keys and references.

One declaration drives the raw CSV layout, the cleaning projection, the reject reasons
and the integrity checks, so the layers cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    raw: str | None = None  # spelling in the raw layer, when it differs
    fold: str | None = None  # lower | upper | title
    blank: str = "null"  # what a blank text becomes: null | keep
    limit: int | None = None  # maximum text length
    must_fill: bool = False  # a blank raw value rejects the row
    required: bool = False  # NOT NULL in the typed layer
    default: str | None = None  # value standing in for a blank
    low: int | None = None  # raised to this bound
    high: int | None = None  # lowered to this bound

    @property
    def source(self) -> str:
        return self.raw or self.name


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    resolve: bool = False  # cleaning keeps only rows whose parent exists
    optional: bool = False  # NULL is allowed


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    file_pattern: str | None = None
    multiline: bool = False

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.source, T.StringType(), True) for f in self.fields])

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


MONEY = "decimal(12,2)"
BIG_MONEY = "decimal(14,2)"
DEGREES = "decimal(10,6)"
TS = "timestamp_ntz"


def _id(name: str, **kw) -> Field:
    return Field(name, limit=50, required=True, blank="keep", **kw)


# Table layouts, text limits, numeric precisions and file names of the raw
# marketplace and funnel extracts.
CUSTOMERS = Contract(
    "customers",
    (
        _id("customer_id", must_fill=True),
        _id("customer_unique_id"),
        Field("customer_zip_code_prefix", "int"),
        Field("customer_city", fold="title", blank="keep", limit=100),
        Field("customer_state", fold="upper", blank="keep", limit=2),
    ),
    key=("customer_id",),
    file_pattern="*customers_dataset.csv",
)
SELLERS = Contract(
    "sellers",
    (
        _id("seller_id", must_fill=True),
        Field("seller_zip_code_prefix", "int"),
        Field("seller_city", fold="lower", blank="keep", limit=100),
        Field("seller_state", fold="upper", blank="keep", limit=2),
    ),
    key=("seller_id",),
    file_pattern="*sellers_dataset.csv",
)
CATEGORY_TRANSLATION = Contract(
    "category_translation",
    (
        Field("product_category_name", limit=100, must_fill=True, required=True),
        Field("product_category_name_english", limit=100, must_fill=True, required=True),
    ),
    key=("product_category_name",),
    file_pattern="product_category_name_translation.csv",
)
PRODUCTS = Contract(
    "products",
    (
        _id("product_id", must_fill=True),
        Field("product_category_name", limit=100),
        Field("product_name_length", "int", raw="product_name_lenght"),
        Field("product_description_length", "int", raw="product_description_lenght"),
        Field("product_photos_qty", "int"),
        Field("product_weight_g", "int"),
        Field("product_length_cm", "int"),
        Field("product_height_cm", "int"),
        Field("product_width_cm", "int"),
    ),
    key=("product_id",),
    file_pattern="*products_dataset.csv",
)
GEOLOCATION = Contract(
    "geolocation",
    (
        Field("geolocation_zip_code_prefix", "int", must_fill=True, required=True),
        Field("geolocation_lat", DEGREES),
        Field("geolocation_lng", DEGREES),
        Field("geolocation_city", fold="lower", blank="keep", limit=100),
        Field("geolocation_state", fold="upper", blank="keep", limit=2),
    ),
    key=("geolocation_id",),
    file_pattern="*geolocation_dataset.csv",
)
ORDERS = Contract(
    "orders",
    (
        _id("order_id", must_fill=True),
        _id("customer_id", must_fill=True),
        Field("order_status", fold="lower", blank="keep", limit=30, required=True),
        Field("order_purchase_timestamp", TS, must_fill=True, required=True),
        Field("order_approved_at", TS),
        Field("order_delivered_carrier_date", TS),
        Field("order_delivered_customer_date", TS),
        Field("order_estimated_delivery_date", TS),
    ),
    key=("order_id",),
    references=(Reference(("customer_id",), "customers", ("customer_id",), resolve=True),),
    file_pattern="*orders_dataset.csv",
)
ORDER_ITEMS = Contract(
    "order_items",
    (
        _id("order_id"),
        Field("order_item_id", "int", must_fill=True, required=True),
        _id("product_id"),
        _id("seller_id"),
        Field("shipping_limit_date", TS),
        Field("price", MONEY, default="0", low=0, required=True),
        Field("freight_value", MONEY, default="0", low=0, required=True),
    ),
    key=("order_id", "order_item_id"),
    references=(
        Reference(("order_id",), "orders", ("order_id",), resolve=True),
        Reference(("product_id",), "products", ("product_id",), resolve=True),
        Reference(("seller_id",), "sellers", ("seller_id",), resolve=True),
    ),
    file_pattern="*order_items_dataset.csv",
)
ORDER_PAYMENTS = Contract(
    "order_payments",
    (
        _id("order_id"),
        Field("payment_sequential", "int", must_fill=True, required=True),
        Field("payment_type", fold="lower", blank="keep", limit=30, required=True),
        Field("payment_installments", "int", default="0"),
        Field("payment_value", MONEY, default="0", low=0, required=True),
    ),
    key=("order_id", "payment_sequential"),
    references=(Reference(("order_id",), "orders", ("order_id",), resolve=True),),
    file_pattern="*order_payments_dataset.csv",
)
ORDER_REVIEWS = Contract(
    "order_reviews",
    (
        _id("review_id", must_fill=True),
        _id("order_id"),
        Field("review_score", "smallint", must_fill=True, required=True, low=1, high=5),
        Field("review_comment_title", limit=255),
        Field("review_comment_message"),
        Field("review_creation_date", TS),
        Field("review_answer_timestamp", TS),
    ),
    key=("review_id",),
    references=(Reference(("order_id",), "orders", ("order_id",), resolve=True),),
    file_pattern="*order_reviews_dataset.csv",
    multiline=True,
)
LEADS = Contract(
    "qualified_leads",
    (
        _id("mql_id", must_fill=True),
        Field("first_contact_date", "date", must_fill=True, required=True),
        Field("landing_page_id", limit=50),
        Field("origin", fold="lower", default="unknown", limit=50),
    ),
    key=("mql_id",),
    file_pattern="*marketing_qualified_leads_dataset.csv",
)
DEALS = Contract(
    "closed_deals",
    (
        _id("mql_id"),
        Field("seller_id", limit=50),
        Field("sdr_id", limit=50),
        Field("sr_id", limit=50),
        Field("won_date", "date", must_fill=True, required=True),
        Field("business_segment", limit=100),
        Field("lead_type", limit=50),
        Field("lead_behaviour_profile", limit=50),
        Field("has_company", "boolean"),
        Field("has_gtin", "boolean"),
        Field("average_stock", limit=50),
        Field("business_type", limit=50),
        Field("declared_product_catalog_size", MONEY),
        Field("declared_monthly_revenue", BIG_MONEY),
    ),
    key=("mql_id",),
    references=(Reference(("mql_id",), "qualified_leads", ("mql_id",), resolve=True),),
    file_pattern="*closed_deals_dataset.csv",
)

CLEAN_TABLES: dict[str, Contract] = {
    c.name: c
    for c in (
        CATEGORY_TRANSLATION,
        CUSTOMERS,
        SELLERS,
        PRODUCTS,
        GEOLOCATION,
        ORDERS,
        ORDER_ITEMS,
        ORDER_PAYMENTS,
        ORDER_REVIEWS,
        LEADS,
        DEALS,
    )
}

DIM_DATE = Contract(
    "dim_date",
    (
        Field("date_key", "int", required=True),
        Field("full_date", "date", required=True),
        Field("day_of_week", "smallint", required=True),
        Field("day_name", limit=10, required=True),
        Field("day_of_month", "smallint", required=True),
        Field("week_of_year", "smallint", required=True),
        Field("month_number", "smallint", required=True),
        Field("month_name", limit=10, required=True),
        Field("quarter", "smallint", required=True),
        Field("year_number", "int", required=True),
        Field("is_weekend", "boolean", required=True),
    ),
    key=("date_key",),
    unique=(("full_date",),),
)
DIM_CUSTOMER = Contract(
    "dim_customer",
    (
        Field("customer_sk", "bigint", required=True),
        Field("customer_id", limit=50, required=True),
        Field("customer_unique_id", limit=50, required=True),
        Field("customer_city", limit=100),
        Field("customer_state", limit=2),
        Field("customer_zip_prefix", "int"),
    ),
    key=("customer_sk",),
    unique=(("customer_id",),),
)
DIM_PRODUCT = Contract(
    "dim_product",
    (
        Field("product_sk", "bigint", required=True),
        Field("product_id", limit=50, required=True),
        Field("product_category_name", limit=100),
        Field("product_category_name_english", limit=100),
        Field("product_weight_g", "int"),
        Field("product_photos_qty", "int"),
    ),
    key=("product_sk",),
    unique=(("product_id",),),
)
DIM_SELLER = Contract(
    "dim_seller",
    (
        Field("seller_sk", "bigint", required=True),
        Field("seller_id", limit=50, required=True),
        Field("seller_city", limit=100),
        Field("seller_state", limit=2),
        Field("seller_zip_prefix", "int"),
    ),
    key=("seller_sk",),
    unique=(("seller_id",),),
)
DIM_ORDER = Contract(
    "dim_order",
    (
        Field("order_sk", "bigint", required=True),
        Field("order_id", limit=50, required=True),
        Field("order_status", limit=30, required=True),
        Field("order_purchase_timestamp", TS, required=True),
        Field("order_approved_at", TS),
        Field("order_delivered_carrier_date", TS),
        Field("order_delivered_customer_date", TS),
        Field("order_estimated_delivery_date", TS),
        Field("delivery_days", "int"),
        Field("estimated_delivery_days", "int"),
        Field("is_late_delivery", "boolean"),
        Field("delay_days", "int"),
    ),
    key=("order_sk",),
    unique=(("order_id",),),
)
DIM_PAYMENT = Contract(
    "dim_payment",
    (
        Field("payment_sk", "bigint", required=True),
        Field("order_id", limit=50, required=True),
        Field("primary_payment_type", limit=30),
        Field("payment_count", "int"),
        Field("total_payment_value", BIG_MONEY),
        Field("max_installments", "int"),
    ),
    key=("payment_sk",),
    unique=(("order_id",),),
)
DIM_REVIEW = Contract(
    "dim_review",
    (
        Field("review_sk", "bigint", required=True),
        Field("order_id", limit=50, required=True),
        Field("review_id", limit=50),
        Field("review_score", "smallint"),
        Field("review_creation_date", TS),
        Field("has_comment", "boolean"),
    ),
    key=("review_sk",),
    unique=(("order_id",),),
)
FACT = Contract(
    "fact_order_items",
    (
        Field("fact_sk", "bigint", required=True),
        Field("order_id", limit=50, required=True),
        Field("order_item_id", "int", required=True),
        Field("date_key", "int", required=True),
        Field("customer_sk", "bigint", required=True),
        Field("product_sk", "bigint", required=True),
        Field("seller_sk", "bigint", required=True),
        Field("order_sk", "bigint", required=True),
        Field("payment_sk", "bigint"),
        Field("review_sk", "bigint"),
        Field("price", MONEY, required=True),
        Field("freight_value", MONEY, required=True),
        Field("item_revenue", MONEY, required=True),
        Field("item_contribution", MONEY, required=True),
        Field("shipping_limit_date", TS),
    ),
    key=("fact_sk",),
    unique=(("order_id", "order_item_id"),),
    references=(
        Reference(("date_key",), "dim_date", ("date_key",)),
        Reference(("customer_sk",), "dim_customer", ("customer_sk",)),
        Reference(("product_sk",), "dim_product", ("product_sk",)),
        Reference(("seller_sk",), "dim_seller", ("seller_sk",)),
        Reference(("order_sk",), "dim_order", ("order_sk",)),
        Reference(("payment_sk",), "dim_payment", ("payment_sk",), optional=True),
        Reference(("review_sk",), "dim_review", ("review_sk",), optional=True),
    ),
)

STAR_TABLES: dict[str, Contract] = {
    c.name: c
    for c in (
        DIM_DATE,
        DIM_CUSTOMER,
        DIM_PRODUCT,
        DIM_SELLER,
        DIM_ORDER,
        DIM_PAYMENT,
        DIM_REVIEW,
        FACT,
    )
}


@dataclass(frozen=True)
class Domain:
    """A row condition that must not be false (NULL passes, as in a CHECK)."""

    table: str
    name: str
    column: str
    low: int | None = None
    high: int | None = None


DOMAINS: tuple[Domain, ...] = (
    Domain("order_items", "price", "price", low=0),
    Domain("order_items", "freight_value", "freight_value", low=0),
    Domain("order_payments", "payment_installments", "payment_installments", low=0),
    Domain("order_payments", "payment_value", "payment_value", low=0),
    Domain("order_reviews", "review_score", "review_score", low=1, high=5),
)

# Accepted header spelling -> spelling of the raw layer.
HEADER_ALIASES = {
    "product_name_length": "product_name_lenght",
    "product_description_length": "product_description_lenght",
}
