"""Row counts per layer, the metric suite with its run log, and the insight document."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.quality import named_counts
from tradewind.operators.star import Star
from tradewind.plans.catalog import INSIGHTS, METRICS, SINGLE_ROW_INSIGHTS
from tradewind.sources.tables import materialize_table

LOG_SCHEMA = (
    "metric_group string, metric string, status string, row_count bigint, "
    "preview array<string>, error string"
)

PLACE = "_place"

# Labels of the row-count reports.
STAGING_LABELS = {
    "customers": "customers",
    "orders": "orders",
    "order_items": "order_items",
    "mqls": "qualified_leads",
    "closed_deals": "closed_deals",
}
CLEANED_LABELS = {
    "customers": "customers",
    "orders": "orders",
    "order_items": "order_items",
    "products": "products",
    "sellers": "sellers",
    "payments": "order_payments",
    "reviews": "order_reviews",
    "mqls": "qualified_leads",
    "closed_deals": "closed_deals",
}


def staging_row_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    return named_counts({k: raw[v] for k, v in STAGING_LABELS.items()}, "t", "n")


def cleaned_row_counts(clean: Mapping[str, DataFrame]) -> DataFrame:
    counts = named_counts({k: clean[v] for k, v in CLEANED_LABELS.items()}, "entity", "count")
    return counts.orderBy("entity")


def star_row_counts(star: Star) -> DataFrame:
    # The line book has one row per fact row.
    tables = {"fact_order_items": star.lines, **star.dims}
    return named_counts({n: tables[n] for n in ["fact_order_items", *star.dims]}, "table_name", "n")


def _run_one(star: Star, name: str, folder: str, preview_rows: int) -> Row:
    """Store one metric's result and describe it; a failure becomes a log row."""
    metric = METRICS[name]
    try:
        plan = metric.run(star)
        # Rows read back from several files come in no certain order, so each stores its place:
        # task numbers, in the upper bits, follow the order of a sorted plan.
        placed = plan.withColumn(PLACE, F.monotonically_increasing_id())
        result = materialize_table(placed, f"{folder}/results/{name}")
        shown = F.to_json(F.struct(*plan.columns)).alias("row")
        head = result.orderBy(PLACE).limit(preview_rows).select(shown).collect()
        return Row(metric.group, name, "ok", result.count(), [r.row for r in head], None)
    except Exception as problem:  # the suite reports failures and goes on
        return Row(metric.group, name, "error", None, None, str(problem))


def run_metric_suite(
    spark: SparkSession,
    star: Star,
    folder: str,
    metrics: Iterable[str] | None = None,
    preview_rows: int = 5,
    parallel: int = 4,
) -> DataFrame:
    """Run every metric, keep going on failures, write results and a JSON run log.

    Each plan runs once: its result is stored with the place of every row in `_place`, and
    counted and previewed from storage.  Small metrics leave most of a cluster idle, so a few
    run side by side; the driver only ever holds the preview rows.
    """
    names = list(METRICS if metrics is None else metrics)
    folder = folder.rstrip("/")
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        log = list(pool.map(lambda n: _run_one(star, n, folder, preview_rows), names))
    table = spark.createDataFrame([tuple(r) for r in log], LOG_SCHEMA)
    table.coalesce(1).write.mode("overwrite").json(f"{folder}/query_run_log")
    return spark.read.schema(LOG_SCHEMA).json(f"{folder}/query_run_log")


def suite_summary(log: DataFrame) -> DataFrame:
    """(ok, total) of a run log."""
    return log.agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count("*").alias("total"))


def export_insights(spark: SparkSession, star: Star, folder: str) -> DataFrame:
    """Write the insight pack as one JSON document and return it read back."""

    def column(name: str):
        one = INSIGHTS[name](star).agg(F.collect_list(F.struct("*")).alias("rows"))
        # Insight results hold at most a handful of rows by construction.
        value = one.select(F.col("rows")[0] if name in SINGLE_ROW_INSIGHTS else F.col("rows"))
        return value.scalar().alias(name)

    document = spark.range(1, numPartitions=1).select(*[column(n) for n in INSIGHTS])
    schema = document.schema
    path = f"{folder.rstrip('/')}/key_insights"
    document.write.mode("overwrite").json(path)
    return spark.read.schema(schema).json(path)

