"""Star schema: seven dimensions, the line fact, and the two wide books metrics read.

The published star has narrow tables joined by surrogate keys.  Metrics do not repeat
those joins: at build time the attributes they need are carried into two columnar books,
one row per order line and one row per order.  Column pruning makes the width free for
readers, and nearly every metric becomes a scan plus a small aggregation.  Lines are
grouped by the 8-byte surrogate keys; names of sellers are looked up on the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import cents, date_key, days_between, from_cents
from tradewind.operators.cleaning import latest_per_key
from tradewind.operators.keys import group_single_keys
from tradewind.operators.numbering import assign_surrogate_keys
from tradewind.sources.contracts import STAR_TABLES
from tradewind.sources.tables import StoredTables, read_layer

UNTRANSLATED = "untranslated"

# Order-level columns of the line book: fact keys, and what line-grain metrics use.
LINE_ATTRIBUTES = (
    "customer_sk",
    "order_sk",
    "payment_sk",
    "review_sk",
    "order_status",
    "is_delivered",
    "delivery_days",
    "is_late_delivery",
    "review_score",
)


def _numbered(
    rows: DataFrame, key: list[str], name: str, keys_only: DataFrame | None = None
) -> DataFrame:
    """Surrogate keys for rows that are stored; they cross the exchange without their slice."""
    return assign_surrogate_keys(rows, key, name, keys_only, carry_slice=False)


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last purchase."""
    span = orders.agg(
        F.min(F.col("order_purchase_timestamp").cast("date")).alias("first_day"),
        F.max(F.col("order_purchase_timestamp").cast("date")).alias("last_day"),
    )
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    iso_day = F.weekday("full_date") + 1
    return days.select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        iso_day.cast("smallint").alias("day_of_week"),
        F.date_format("full_date", "E").alias("day_name"),
        F.dayofmonth("full_date").cast("smallint").alias("day_of_month"),
        F.weekofyear("full_date").cast("smallint").alias("week_of_year"),
        F.month("full_date").cast("smallint").alias("month_number"),
        F.date_format("full_date", "MMM").alias("month_name"),
        F.quarter("full_date").cast("smallint").alias("quarter"),
        F.year("full_date").alias("year_number"),
        (iso_day >= 6).alias("is_weekend"),
    )


def build_dim_customer(customers: DataFrame) -> DataFrame:
    rows = customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        F.col("customer_zip_code_prefix").alias("customer_zip_prefix"),
    )
    return _numbered(rows, ["customer_id"], "customer_sk")


def build_dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; a missing translation is named as such."""
    rows = products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", F.lit(UNTRANSLATED)).alias(
            "product_category_name_english"
        ),
        "product_weight_g",
        "product_photos_qty",
    )
    return _numbered(rows, ["product_id"], "product_sk", products)


def build_dim_seller(sellers: DataFrame) -> DataFrame:
    rows = sellers.select(
        "seller_id",
        "seller_city",
        "seller_state",
        F.col("seller_zip_code_prefix").alias("seller_zip_prefix"),
    )
    return _numbered(rows, ["seller_id"], "seller_sk")


def build_dim_order(orders: DataFrame) -> DataFrame:
    """Orders with delivery figures; lateness compares instants, delay compares dates."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    rows = orders.select(
        "order_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    # Figures are derived behind the numbering, so its exchange does not carry them.
    return _numbered(rows, ["order_id"], "order_sk").select(
        "*",
        days_between(purchased, delivered).alias("delivery_days"),
        days_between(purchased, promised).alias("estimated_delivery_days"),
        (delivered > promised).alias("is_late_delivery"),
        days_between(promised, delivered).alias("delay_days"),
    )


def build_dim_payment(payments: DataFrame) -> DataFrame:
    """One row per order: type of the first payment, number, total, longest plan."""
    rows = payments.groupBy("order_id").agg(
        F.min_by("payment_type", "payment_sequential").alias("primary_payment_type"),
        F.count(F.lit(1)).cast("int").alias("payment_count"),
        F.sum(cents(F.col("payment_value"))).alias("_total"),
        F.max("payment_installments").alias("max_installments"),
    )
    rows = rows.select(
        "order_id",
        "primary_payment_type",
        "payment_count",
        from_cents(F.col("_total")).cast("decimal(14,2)").alias("total_payment_value"),
        "max_installments",
    )
    keys = payments.select("order_id").distinct()
    return _numbered(rows, ["order_id"], "payment_sk", keys)


def build_dim_review(reviews: DataFrame) -> DataFrame:
    """One row per order: its latest review."""
    newest = latest_per_key(
        reviews.select(
            "order_id",
            "review_id",
            "review_score",
            "review_creation_date",
            F.col("review_comment_message").isNotNull().alias("has_comment"),
        ),
        ["order_id"],
        [F.desc_nulls_last("review_creation_date"), F.asc("review_id")],
    )
    keys = reviews.select("order_id").distinct()
    return _numbered(newest, ["order_id"], "review_sk", keys)


def build_order_frame(orders: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order: its keys and the attributes its lines carry.

    All keys are unique here, so no join can be skewed.  The customer join comes before
    the joins by order, which then share one partitioning.
    """
    reviews = dims["dim_review"].select("order_id", "review_sk", "review_score")
    payments = dims["dim_payment"].select(
        "order_id",
        "payment_sk",
        "primary_payment_type",
        "max_installments",
        cents(F.col("total_payment_value")).alias("paid_cents"),
    )
    return (
        orders.select("order_id", "customer_id")
        .join(dims["dim_customer"], "customer_id")
        .join(dims["dim_order"], "order_id")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
        .select(
            "order_id",
            "order_sk",
            "customer_sk",
            "payment_sk",
            "review_sk",
            F.col("order_purchase_timestamp").cast("date").alias("purchase_date"),
            "order_status",
            F.col("order_delivered_customer_date").isNotNull().alias("is_delivered"),
            "delivery_days",
            "is_late_delivery",
            "review_score",
            "customer_unique_id",
            "customer_state",
            "primary_payment_type",
            "max_installments",
            "paid_cents",
        )
    )


def _line_parents(
    order_frame: DataFrame, dims: Mapping[str, DataFrame]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a line looks up: product, seller and order."""
    products = dims["dim_product"].select(
        "product_id", "product_sk", F.col("product_category_name_english").alias("category")
    )
    sellers = dims["dim_seller"].select("seller_id", "seller_sk")
    orders = order_frame.select(
        "order_id", date_key(F.col("purchase_date")).alias("date_key"), *LINE_ATTRIBUTES
    )
    return products, sellers, orders


def build_line_book(
    items: DataFrame, order_frame: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One wide row per order line: all fact keys plus the attributes metrics group by.

    Each join has a stored table on its small side and picks its strategy from measured
    sizes: broadcast while that side is small, otherwise a sort-merge join.  With an
    exchange of its own on both sides AQE can split a key that owns many lines, be it an
    order, a product or a seller.  That is why the order frame is stored first: joined
    lazily it would share the exchange of its own joins and could not be split.
    """
    products, sellers, carried = _line_parents(order_frame, dims)
    # Numbered while still narrow.  Cleaning has resolved every parent, so the joins below
    # neither drop nor repeat a line; `require_all_lines` holds a stored star to that.
    numbered = _numbered(items, ["order_id", "order_item_id"], "fact_sk")
    # The wide order attributes come last, so no other join has to shuffle them.
    return (
        numbered.join(products, "product_id")
        .join(sellers, "seller_id")
        .join(carried, "order_id")
        .select(
            "fact_sk",
            "order_id",
            "order_item_id",
            "date_key",
            "product_sk",
            "seller_sk",
            cents(F.col("price")).alias("price_cents"),
            cents(F.col("freight_value")).alias("freight_cents"),
            "shipping_limit_date",
            "category",
            *LINE_ATTRIBUTES,
        )
    )


def build_metric_lines(
    items: DataFrame, order_frame: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """The line book without what only the published fact has: number, line and shipping limit.

    No metric reads those, so a star that is not published saves its lines the exchange of the
    numbering, and the joins carry four columns less.
    """
    products, sellers, carried = _line_parents(order_frame, dims)
    narrow = items.select(
        "order_id",
        "product_id",
        "seller_id",
        cents(F.col("price")).alias("price_cents"),
        cents(F.col("freight_value")).alias("freight_cents"),
    )
    return (
        narrow.join(products, "product_id")
        .join(sellers, "seller_id")
        .join(carried, "order_id")
        .select(
            "date_key",
            "product_sk",
            "seller_sk",
            "price_cents",
            "freight_cents",
            "category",
            *LINE_ATTRIBUTES,
        )
    )


def build_fact_order_items(line_book: DataFrame) -> DataFrame:
    """The published fact: a projection of the line book."""
    money = "decimal(12,2)"
    price = from_cents(F.col("price_cents")).cast(money)
    freight = from_cents(F.col("freight_cents")).cast(money)
    contribution = from_cents(F.col("price_cents") - F.col("freight_cents")).cast(money)
    computed = {
        "price": price,
        "freight_value": freight,
        "item_revenue": price,
        "item_contribution": contribution,
    }
    names = [f.name for f in STAR_TABLES["fact_order_items"].fields]
    return line_book.select(*[computed.get(n, F.col(n)).alias(n) for n in names])


def build_order_book(line_book: DataFrame, order_frame: DataFrame) -> DataFrame:
    """One row per order that has lines: its attributes and line totals.

    Lines are combined on the map side and cross one exchange; metrics about orders,
    customers, months and days then read this smaller table without COUNT(DISTINCT).
    """
    totals = line_book.groupBy("order_sk").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("price_cents").alias("revenue_cents"),
        F.sum("freight_cents").alias("freight_cents"),
    )
    orders = order_frame.drop("customer_sk")
    return totals.join(orders, "order_sk")


def build_seller_book(line_book: DataFrame) -> DataFrame:
    """One row per seller and order: line totals and the order's delivery and review.

    Orders per seller then are plain counts, combined on the map side, where the lines would
    need a distinct count that shuffles nearly all of them for every metric.  They are dealt out
    by order: a stored line book holds an order's lines next to each other, with equal figures of
    the order, and such rows compress well on their way.
    """
    of_order = ["is_delivered", "delivery_days", "is_late_delivery", "review_score"]
    key = ["seller_sk", "order_sk"]

    def per_pair(part: DataFrame) -> DataFrame:
        return part.groupBy(*key).agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("price_cents").alias("price_cents"),
            # Equal on all lines of an order.
            *[F.first(c).alias(c) for c in of_order],
        )

    lines = line_book.select(*key, "price_cents", *of_order)
    return group_single_keys(lines, key, per_pair, deal_by=["order_sk"])


@dataclass(frozen=True)
class Star:
    """Everything the metric plans read."""

    lines: DataFrame  # line book
    orders: DataFrame  # order book
    sellers: DataFrame  # seller book
    frame: DataFrame  # order frame
    dims: Mapping[str, DataFrame]
    clean: Mapping[str, DataFrame]

    @property
    def numbered_lines(self) -> DataFrame:
        return self.lines

    @property
    def fact(self) -> DataFrame:
        return build_fact_order_items(self.numbered_lines)

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_order_items": self.fact, **self.dims}


# Wide tables that metrics read, in the order of the fields of Star.
BOOKS = ("line_book", "order_book", "seller_book", "order_frame")


def dim_plans(clean: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """The plan of every dimension; each reads its own clean tables."""
    return {
        "dim_date": lambda: build_dim_date(clean["orders"]),
        "dim_customer": lambda: build_dim_customer(clean["customers"]),
        "dim_product": lambda: build_dim_product(clean["products"], clean["category_translation"]),
        "dim_seller": lambda: build_dim_seller(clean["sellers"]),
        "dim_order": lambda: build_dim_order(clean["orders"]),
        "dim_payment": lambda: build_dim_payment(clean["order_payments"]),
        "dim_review": lambda: build_dim_review(clean["order_reviews"]),
    }


def build_dims(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: plan() for name, plan in dim_plans(clean).items()}


class StarOnUse:
    """A star below `root` whose tables are stored when a plan first reads them.

    Readers use it like `Star`.  A metric over one dimension stores that dimension alone, one
    over lines stores no book but theirs; `whole` stores everything that is still missing.
    Lines are numbered for readers of the fact; metrics get them without, unless they are there.
    """

    def __init__(self, clean: Mapping[str, DataFrame], root: str, partition_by_month: bool = False):
        self.clean, root = clean, root.rstrip("/")
        self.dims = StoredTables(dim_plans(clean), root)
        layout = ["purchase_month"] if partition_by_month else []

        def by_month(book: DataFrame, month: Column) -> DataFrame:
            return book.withColumn("purchase_month", month.cast("int")) if layout else book

        def line_book() -> DataFrame:
            lines = build_line_book(clean["order_items"], self.frame, self.dims)
            return by_month(lines, F.floor(F.col("date_key") / 100))

        def metric_lines() -> DataFrame:
            lines = build_metric_lines(clean["order_items"], self.frame, self.dims)
            return by_month(lines, F.floor(F.col("date_key") / 100))

        def order_book() -> DataFrame:
            orders = build_order_book(self.lines, self.frame)
            return by_month(orders, F.floor(date_key(F.col("purchase_date")) / 100))

        plans = {
            "line_book": line_book,
            "metric_lines": metric_lines,
            "order_book": order_book,
            "seller_book": lambda: build_seller_book(self.lines),
            "order_frame": self._order_frame,
        }
        layouts = dict.fromkeys(("line_book", "metric_lines", "order_book"), layout)
        self._books = StoredTables(plans, root, layouts)

    def _order_frame(self) -> DataFrame:
        self.dims.all(["dim_customer", "dim_order", "dim_payment", "dim_review"])
        return build_order_frame(self.clean["orders"], self.dims)

    numbered_lines = property(lambda self: self._books["line_book"])
    orders = property(lambda self: self._books["order_book"])
    sellers = property(lambda self: self._books["seller_book"])
    frame = property(lambda self: self._books["order_frame"])

    @property
    def lines(self) -> DataFrame:
        return self._books["line_book" if self._books.holds("line_book") else "metric_lines"]

    @property
    def fact(self) -> DataFrame:
        return build_fact_order_items(self.numbered_lines)

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_order_items": self.fact, **self.dims.all()}

    def whole(self) -> Star:
        """Everything stored; dimensions do not depend on each other and are written side by side."""
        dims = self.dims.all()
        lines = self.numbered_lines  # first: the other books read it
        return Star(lines, self.orders, self.sellers, self.frame, dims, dict(self.clean))


def build_star(
    spark: SparkSession,
    clean: Mapping[str, DataFrame],
    root: str,
    partition_by_month: bool = False,
) -> Star:
    """Write dimensions, line book and order book below `root`; return them read back.

    With `partition_by_month` the books are laid out by purchase month for readers that filter
    on time; none of the built-in metrics does, so it is off by default.
    """
    return StarOnUse(clean, root, partition_by_month).whole()


def require_all_lines(star: Star | StarOnUse) -> None:
    """Stop if the line book is not the clean lines, numbered 1 to N.

    Two counts over stored tables, read from their footers or one narrow column.
    """
    items = star.clean["order_items"].count()
    lines, low, high = star.numbered_lines.agg(
        F.count(F.lit(1)), F.min("fact_sk"), F.max("fact_sk")
    ).first()
    if lines != items or (lines and (low, high) != (1, lines)):
        raise ValueError(
            f"{items} clean lines gave {lines} lines in the star, numbered {low} to {high}"
        )


def star_table_names() -> list[str]:
    """Everything that `build_star` writes."""
    return [n for n in STAR_TABLES if n != "fact_order_items"] + list(BOOKS)


def open_star(spark: SparkSession, root: str) -> Star:
    """The star of the current version below a root, with the clean layer it was built from."""
    stored = read_layer(spark, root, "star")
    dims = {n: stored[n] for n in STAR_TABLES if n != "fact_order_items"}
    return Star(*(stored[n] for n in BOOKS), dims, read_layer(spark, root))
