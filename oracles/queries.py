"""Every operator and metric as a query over the test tables.

Layers are built once per session and data folder, stored below the shared scratch folder
and read by the queries that come after, as in a production run: clean tables, then the
star, then metrics.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache, reduce
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracles.roles import read_base, spark_role
from oracles.sql import BROKEN_CHECKS, PATH_METRICS, TEST_THRESHOLDS
from tradewind.functions import truth_value
from tradewind.operators import cleaning, integrity, numbering, star as builders
from tradewind.operators.quality import named_counts
from tradewind.plans import suite
from tradewind.plans.catalog import INSIGHTS, METRICS
from tradewind.session import scratch_path
from tradewind.sources import landing, tables
from tradewind.sources.contracts import CLEAN_TABLES, STAR_TABLES

Query = Callable[[SparkSession, str], DataFrame]

ROLE_OF = {
    "category_translation": "r_translation",
    "customers": "r_customers",
    "sellers": "r_sellers",
    "products": "r_products",
    "orders": "r_orders",
    "order_items": "r_items",
    "order_payments": "r_payments",
    "qualified_leads": "r_leads",
    "closed_deals": "r_deals",
}
BROKEN_ROLE_OF = {
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


class Inputs:
    """Layers of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, object] = {}
        self._planning = RLock()

    def _once(self, name: str, build):
        if name not in self._stored:
            self._stored[name] = build()
        return self._stored[name]

    def role(self, name: str) -> DataFrame:
        with self._planning:  # tables stored side by side ask for their roles at once
            base = self._once("base", lambda: read_base(self.spark, self.sf_dir))
            return self._once(name, lambda: spark_role(base, name))

    def raw(self) -> tables.StoredTables:
        """The raw layer: dirty text as stored tables."""
        plans = {t: lambda t=t: self.role(f"w_{t}") for t in CLEAN_TABLES}
        return self._layer("raw", plans)

    def _layer(self, name: str, plans: dict[str, Callable[[], DataFrame]]) -> tables.StoredTables:
        # Each table is stored when a query first reads it, in as many files as its plan has
        # tasks.  Dealing the rows out evenly would sort every map task's share by hash first,
        # and a few large shares spill.
        return self._once(
            name, lambda: tables.StoredTables(plans, scratch_path(self.spark, name))
        )

    def cleaned(self) -> tables.StoredTables:
        """The clean layer that the dirty text gives; children resolve against stored parents."""

        def rows(table: str) -> DataFrame:
            raw, done = self.raw(), self.cleaned()
            if table in PARENTS_OF:
                known = done.all(PARENTS_OF[table])
                return cleaning.clean_child(raw, table, known, store_lost=True).rows
            return FREE[table](raw[table]).rows

        return self._layer("cleaned", {t: lambda t=t: rows(t) for t in CLEAN_TABLES})

    def cleaned_star(self) -> builders.StarOnUse:
        """The star over the cleaned text; no line may get lost."""

        def build():
            self.cleaned().all()
            star = builders.StarOnUse(self.cleaned(), scratch_path(self.spark, "cleaned-star"))
            builders.require_all_lines(star)
            integrity.require_constraints(self.cleaned().all(), CLEAN_TABLES)
            return star

        return self._once("cleaned_star", build)

    def broken(self) -> dict[str, DataFrame]:
        return {t: self.role(r) for t, r in BROKEN_ROLE_OF.items()}

    def typed(self) -> dict[str, DataFrame]:
        """Clean typed tables, lazily derived."""
        out = {t: self.role(r) for t, r in ROLE_OF.items()}
        out["order_reviews"] = cleaning.latest_reviews(self.role("r_reviews_all"))
        return out

    def clean(self) -> tables.StoredTables:
        """The clean layer as stored tables."""

        def rows(table: str) -> DataFrame:
            if table == "order_reviews":
                return cleaning.latest_reviews(self.role("r_reviews_all"))
            return self.role(ROLE_OF[table])

        return self._layer("clean", {t: lambda t=t: rows(t) for t in (*ROLE_OF, "order_reviews")})

    def star(self) -> builders.StarOnUse:
        return self._once(
            "star", lambda: builders.StarOnUse(self.clean(), scratch_path(self.spark, "star"))
        )

    def whole_star(self) -> builders.Star:
        """The star for queries that read all of it."""
        self.clean().all()
        return self.star().whole()

    def csv_folder(self) -> str:
        """The raw tables as CSV files under the names the loader looks for."""

        def build():
            root = scratch_path(self.spark, "csv")

            def store(name: str) -> None:
                target = CLEAN_TABLES[name].file_pattern.replace("*", "raw_")
                (
                    self.role(f"w_{name}")
                    .write.option("header", True)
                    .option("escape", '"')
                    .option("ignoreLeadingWhiteSpace", False)
                    .option("ignoreTrailingWhiteSpace", False)
                    .csv(f"{root}/{target}")
                )

            with ThreadPoolExecutor(max_workers=tables.WRITERS) as pool:
                list(pool.map(store, CLEAN_TABLES))
            return root

        return self._once("csv", build)


@lru_cache(maxsize=8)
def _inputs(application: str, sf_dir: str) -> Inputs:
    return Inputs(SparkSession.active(), sf_dir)


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return _inputs(spark.sparkContext.applicationId, sf_dir.rstrip("/"))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and integers as BIGINT, the types the checker's SQL returns."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(f"`{f.name}`").cast("bigint").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*[shown(f) for f in df.schema.fields])


# --- sources and sinks ----------------------------------------------------------------


def load_staging_csv(x: Inputs) -> DataFrame:
    """Rows and characters of every table as the CSV files give them back."""

    def measured(name: str) -> DataFrame:
        rows = landing.load_staging_csv(x.spark, x.csv_folder(), name)
        chars = sum(F.coalesce(F.length(F.col(c)), F.lit(0)) for c in rows.columns)
        return rows.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.sum(chars).cast("long").alias("characters"),
        )

    return reduce(DataFrame.unionByName, [measured(n) for n in CLEAN_TABLES])


def load_inferred_csv(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "inferred")
    x.role("r_items").write.option("header", True).csv(path)
    return landing.load_inferred_csv(x.spark, path)


def load_inferred_tables(x: Inputs) -> DataFrame:
    """The inferred type of every column of every file, and how many values it holds."""

    def held(name: str, df: DataFrame) -> DataFrame:
        columns = [
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias("n"))
            for c, t in df.dtypes
        ]
        return df.agg(F.explode(F.array(*columns)).alias("c")).select(F.lit(name).alias("table_name"), "c.*")

    found = landing.load_inferred(x.spark, x.csv_folder())
    return reduce(DataFrame.unionByName, [held(n, df) for n, df in found.items()])


def normalize_headers(x: Inputs) -> DataFrame:
    corrected = x.role("w_products").withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )
    return landing.normalize_headers(corrected)


def overwrite_layer(x: Inputs) -> DataFrame:
    root = scratch_path(x.spark, "layer")
    broken, typed = x.broken(), x.typed()
    names = list(broken)
    tables.overwrite_layer(x.spark, {n: broken[n] for n in names}, root)
    tables.overwrite_layer(x.spark, {n: typed[n] for n in names}, root)
    return named_counts(tables.read_layer(x.spark, root), "table_name", "n")


def materialize_table(x: Inputs) -> DataFrame:
    month = F.date_format("order_purchase_timestamp", "yyyy-MM").alias("purchase_month")
    orders = x.role("r_orders").select("order_id", "order_status", month)
    path = scratch_path(x.spark, "ctas")
    stored = tables.materialize_table(orders, path, partition_by=["purchase_month"])
    return stored.groupBy("purchase_month", "order_status").agg(F.count(F.lit(1)).alias("n"))


def publish_bi_tables(x: Inputs) -> DataFrame:
    star = x.whole_star()
    wanted = {**star.tables(), **{n: star.clean[n] for n in ("qualified_leads", "closed_deals")}}
    return named_counts(
        tables.publish_bi_tables(x.spark, wanted, scratch_path(x.spark, "bi")), "table_name", "n"
    )


def run_metric_suite(x: Inputs) -> DataFrame:
    log = suite.run_metric_suite(x.spark, x.whole_star(), scratch_path(x.spark, "suite"))
    return log.select("metric", "status", "row_count")


def export_insights(x: Inputs) -> DataFrame:
    document = suite.export_insights(x.spark, x.star(), scratch_path(x.spark, "insights"))
    late = F.filter("late_vs_ontime_reviews", lambda r: r["status"] == "Late")[0]
    top = F.aggregate(
        "top_categories",
        F.lit(0).cast("decimal(24,2)"),
        lambda total, r: (total + r["revenue"]).cast("decimal(24,2)"),
    )
    return document.select(
        "snapshot.*",
        "repeat_rate.*",
        "funnel.conversion_pct",
        "on_time_pct.*",
        late["n"].alias("late_n"),
        top.alias("top_revenue"),
    )


# --- cleaning and integrity -------------------------------------------------------------


FREE = {
    "category_translation": cleaning.clean_categories,
    "customers": cleaning.clean_customers,
    "sellers": cleaning.clean_sellers,
    "products": cleaning.clean_products,
    "geolocation": cleaning.clean_geolocation,
    "qualified_leads": cleaning.clean_leads,
}
PARENTS_OF = {t: [r.parent for r in CLEAN_TABLES[t].references if r.resolve] for t in cleaning.CHILDREN}


def _clean_rows(table: str) -> Callable[[Inputs], DataFrame]:
    def query(x: Inputs) -> DataFrame:
        raw = x.raw()
        if table in PARENTS_OF:
            parents = x.cleaned().all(PARENTS_OF[table])
            return cleaning.clean_child(raw, table, parents, store_lost=True).rows
        if table == "category_translation":
            return cleaning.clean_categories(raw[table]).rows
        if table == "geolocation":
            return cleaning.clean_geolocation(raw[table]).rows.drop("geolocation_id")
        return cleaning.clean_table(raw[table], CLEAN_TABLES[table]).rows

    return query


def normalize_boolean(x: Inputs) -> DataFrame:
    flags = [truth_value(F.col(c)).alias(c) for c in ("has_company", "has_gtin")]
    return x.role("w_closed_deals").select("mql_id", *flags)


def _refused(x: Inputs) -> DataFrame:
    raw = x.raw().all()
    parents = x.cleaned().all(sorted({p for names in PARENTS_OF.values() for p in names}))
    return cleaning.quarantine_rejects(
        cleaning.clean_parents(raw),
        cleaning.clean_ordered(raw, parents, store_lost=True),
        cleaning.clean_children(raw, parents, store_lost=True),
    )


def quarantine_rejects(x: Inputs) -> DataFrame:
    return _refused(x).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def check_foreign_keys(x: Inputs) -> DataFrame:
    star = x.star()
    own = {"fact_order_items": star.fact, **star.dims}
    return integrity.check_foreign_keys(x.broken(), CLEAN_TABLES).unionByName(
        integrity.check_foreign_keys(own, STAR_TABLES)
    )


def check_unique(x: Inputs) -> DataFrame:
    # The line number of the raw table repeats within an order.
    own = {**x.star().dims, "fact_order_items": x.role("x_items")}
    return integrity.check_unique(own, STAR_TABLES)


# --- star -----------------------------------------------------------------------------


def build_fact(x: Inputs) -> DataFrame:
    clean, dims = x.clean(), x.star().dims
    frame = builders.build_order_frame(clean["orders"], dims)
    book = builders.build_line_book(clean["order_items"], frame, dims)
    return builders.build_fact_order_items(book)


OPERATORS: dict[str, Callable[[Inputs], DataFrame]] = {
    "load_staging_csv": load_staging_csv,
    "load_inferred_csv": load_inferred_csv,
    "load_inferred_tables": load_inferred_tables,
    "normalize_headers": normalize_headers,
    "overwrite_layer": overwrite_layer,
    "materialize_table": materialize_table,
    "staging_row_counts": lambda x: suite.staging_row_counts(
        landing.load_staging(x.spark, x.csv_folder())
    ),
    "cleaned_row_counts": lambda x: suite.cleaned_row_counts(x.clean().all()),
    "star_row_counts": lambda x: suite.star_row_counts(x.star()),
    "run_metric_suite": run_metric_suite,
    "export_insights": export_insights,
    "publish_bi_tables": publish_bi_tables,
    "clean_categories": _clean_rows("category_translation"),
    "clean_customers": _clean_rows("customers"),
    "clean_sellers": _clean_rows("sellers"),
    "clean_products": _clean_rows("products"),
    "clean_geolocation": _clean_rows("geolocation"),
    "clean_orders": _clean_rows("orders"),
    "clean_order_items": _clean_rows("order_items"),
    "clean_payments": _clean_rows("order_payments"),
    "clean_reviews": _clean_rows("order_reviews"),
    "clean_leads": _clean_rows("qualified_leads"),
    "clean_deals": _clean_rows("closed_deals"),
    "normalize_boolean": normalize_boolean,
    "quarantine_rejects": quarantine_rejects,
    "check_primary_keys": lambda x: integrity.check_primary_keys(x.broken(), CLEAN_TABLES),
    "check_foreign_keys": check_foreign_keys,
    "check_domains": lambda x: integrity.check_domains(x.broken()),
    "check_unique": check_unique,
    "check_not_null": lambda x: integrity.check_not_null(x.broken(), CLEAN_TABLES),
    "check_type_bounds": lambda x: integrity.check_type_bounds(x.raw().all(), CLEAN_TABLES),
    "build_dim_date": lambda x: builders.build_dim_date(x.clean()["orders"]),
    "build_dim_customer": lambda x: builders.build_dim_customer(x.clean()["customers"]),
    "build_dim_product": lambda x: builders.build_dim_product(
        x.clean()["products"], x.clean()["category_translation"]
    ),
    "build_dim_seller": lambda x: builders.build_dim_seller(x.clean()["sellers"]),
    "build_dim_order": lambda x: builders.build_dim_order(x.clean()["orders"]),
    "build_dim_payment": lambda x: builders.build_dim_payment(x.clean()["order_payments"]),
    "build_dim_review": lambda x: builders.build_dim_review(x.clean()["order_reviews"]),
    "build_fact_order_items": build_fact,
    "assign_surrogate_keys": lambda x: numbering.assign_surrogate_keys(
        x.clean()["order_payments"].select("order_id", "payment_sequential"),
        ["order_id", "payment_sequential"],
        "payment_row",
    ),
}

def pipeline_counts(x: Inputs) -> DataFrame:
    names = [t for t in CLEAN_TABLES if t != "geolocation"]
    counted = {n: x.cleaned()[n] for n in names} | {"fact_order_items": x.cleaned_star().lines}
    return named_counts(counted, "table_name", "n")


def pipeline_quarantine(x: Inputs) -> DataFrame:
    first = F.lit(None).cast("string")
    for name in CLEAN_TABLES:
        key = CLEAN_TABLES[name].fields[0].source
        own = F.get_json_object("raw_row", f"$.{key}")
        first = F.when(F.col("table_name") == name, own).otherwise(first)
    return _refused(x).groupBy("table_name", "reason", first.alias("raw_key")).agg(
        F.count(F.lit(1)).alias("n")
    )


OPERATORS |= {
    "pipeline_counts": pipeline_counts,
    "pipeline_quarantine": pipeline_quarantine,
    **{
        f"pipeline_{name}": lambda x, name=name: METRICS[name].plan(x.cleaned_star())
        for name in PATH_METRICS
    },
}

# Names of the insight queries -> names inside the pack.
INSIGHT_QUERIES = {
    "insight_snapshot": "snapshot",
    "insight_late_reviews": "late_vs_ontime_reviews",
    "insight_repeat_rate": "repeat_rate",
    "insight_top_categories": "top_categories",
    "insight_funnel": "funnel",
    "insight_on_time": "on_time_pct",
}


def _metric(name: str) -> Callable[[Inputs], DataFrame]:
    def query(x: Inputs) -> DataFrame:
        metric = METRICS[name]
        if name in BROKEN_CHECKS:
            return metric.plan(x.broken())
        if metric.reads == "clean":
            return metric.plan(x.clean())
        return metric.plan(x.star(), **TEST_THRESHOLDS.get(name, {}))

    return query


def queries() -> dict[str, Query]:
    plans = dict(OPERATORS)
    plans.update({n: _metric(n) for n in METRICS})
    for query, insight in INSIGHT_QUERIES.items():
        plans[query] = lambda x, insight=insight: INSIGHTS[insight](x.star())

    def bound(plan) -> Query:
        return lambda spark, sf_dir: plain(plan(inputs(spark, sf_dir)))

    return {name: bound(plan) for name, plan in plans.items()}
