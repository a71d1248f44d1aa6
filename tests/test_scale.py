"""Plans and task sizes when one key owns a third of the rows or more."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.market import raw_frames
from tradewind.operators import keys, star as builders
from tradewind.operators.cleaning import clean_all, latest_reviews
from tradewind.operators.integrity import count_keys, duplicate_keys
from tradewind.operators.quality import volume_snapshot
from tradewind.plans.catalog import METRICS
from tradewind.session import sizing_conf

ROWS = 60_000


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def largest_reader(df, key) -> float:
    """Share of the rows that the fullest partition of an exchange by `key` would read."""
    parts = df.repartition(8, *key).groupBy(F.spark_partition_id()).count().collect()
    return max(r["count"] for r in parts) / sum(r["count"] for r in parts)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    rows, _ = clean_all(raw_frames(spark))
    return builders.build_star(spark, rows, str(tmp_path_factory.mktemp("star")))


@pytest.fixture(scope="module")
def hot_star(spark, tmp_path_factory):
    """Half of the lines: one seller, one product, one customer and one order."""
    hot = F.col("id") % 2 == 0
    base = spark.range(ROWS, numPartitions=8)

    def pick(n: int, name: str):
        return F.when(hot, 0).otherwise(F.col("id") % n).cast("string").alias(name)

    items = base.select(
        pick(5000, "order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        pick(500, "product_id"),
        pick(300, "seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        (F.col("id") % 900 + 1).cast("decimal(12,2)").alias("price"),
        F.lit(1).cast("decimal(12,2)").alias("freight_value"),
    )
    day = F.expr("timestamp_ntz'2020-01-01 10:00:00' + make_dt_interval(cast(id % 400 as int))")
    orders = spark.range(5000).select(
        F.col("id").cast("string").alias("order_id"),
        F.col("id").cast("string").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        day.alias("order_approved_at"),
        day.alias("order_delivered_carrier_date"),
        (day + F.expr("interval 5 days")).alias("order_delivered_customer_date"),
        (day + F.expr("make_dt_interval(cast(id % 9 as int))")).alias(
            "order_estimated_delivery_date"
        ),
    )
    customers = spark.range(5000).select(
        F.col("id").cast("string").alias("customer_id"),
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("customer_unique_id"),
        F.lit(1).alias("customer_zip_code_prefix"),
        F.lit("City").alias("customer_city"),
        F.when(hot, "SP").otherwise(F.concat(F.lit("S"), F.col("id") % 9)).alias("customer_state"),
    )
    rows, _ = clean_all(raw_frames(spark))
    clean = {
        **rows,
        "order_items": items,
        "orders": orders,
        "customers": customers,
        "products": spark.range(500).select(
            F.col("id").cast("string").alias("product_id"),
            F.when(hot, "livros").otherwise("moveis").alias("product_category_name"),
            F.lit(1).alias("product_weight_g"),
            F.lit(1).alias("product_photos_qty"),
        ),
        "sellers": spark.range(300).select(
            F.col("id").cast("string").alias("seller_id"),
            F.lit(1).alias("seller_zip_code_prefix"),
            F.lit("x").alias("seller_city"),
            F.lit("SP").alias("seller_state"),
        ),
    }
    return builders.build_star(spark, clean, str(tmp_path_factory.mktemp("hot")))


def test_hot_keys_lose_no_rows(hot_star):
    assert hot_star.lines.count() == ROWS
    assert hot_star.orders.agg(F.sum("line_count")).first()[0] == ROWS
    best = METRICS["top_sellers"].run(hot_star, min_orders=1).first()
    own = hot_star.clean["order_items"].where("seller_id = '0'").count()
    assert (best.seller_id, best["items"]) == ("0", own)
    assert best["items"] >= ROWS // 2
    keys = hot_star.lines.agg(F.min("fact_sk"), F.max("fact_sk"), F.count_distinct("fact_sk"))
    assert tuple(keys.first()) == (1, ROWS, ROWS)


def test_number_slices_spread_a_hot_order(hot_star):
    """Lines of one order fall into different slices because the key holds the line too."""
    from tradewind.operators.numbering import key_slice

    sliced = hot_star.lines.select(key_slice(["order_id", "order_item_id"]).alias("s"))
    assert largest_reader(sliced, ["s"]) < 0.2
    assert largest_reader(hot_star.lines, ["order_id"]) > 0.45  # what it avoids


def exchanges(df) -> list[tuple[str, int]]:
    """(partitioning, rows written) of every exchange of the executed plan."""
    df.collect()
    found = []
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            stack.append(node.plan())
        else:
            if name == "Exchange":
                rows = node.metrics().apply("shuffleRecordsWritten").value()
                found.append((node.outputPartitioning().toString(), rows))
            children = node.children()
            stack.extend(children.apply(i) for i in range(children.size()))
    return found


def exchanged_rows(df) -> int:
    return sum(rows for _, rows in exchanges(df))


@pytest.mark.parametrize(
    "name,limit",
    [
        ("monthly_gmv", 400),
        ("price_bands", 100),
        ("top_categories", 100),
        ("seller_state_contribution", 8_000),
        ("sellers_above_category_avg", 9_000),
        ("late_by_state", 200),
        ("delivery_buckets", 200),
        ("kpi_on_time", 100),
        ("rolling_7d", 8_000),
        ("repeat_by_state", 8_000),
    ],
)
def test_rows_are_combined_before_the_exchange(hot_star, name, limit):
    assert exchanged_rows(METRICS[name].run(hot_star)) <= limit


def test_latest_review_of_a_hot_id_crosses_as_one_row_per_task(spark):
    reviews = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("review_id"),
        F.col("id").cast("string").alias("order_id"),
        F.lit(3).cast("smallint").alias("review_score"),
        F.lit("t").alias("review_comment_title"),
        F.lit("m").alias("review_comment_message"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 99 as int))").alias(
            "review_creation_date"
        ),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"),
    )
    latest = latest_reviews(reviews)
    assert latest.count() == 20_001
    assert exchanged_rows(latest) <= 20_000 + 8


def test_duplicate_check_of_a_hot_key_crosses_combined(spark):
    df = spark.range(40_000, numPartitions=8).select(F.lit("same").alias("k"))
    dup = duplicate_keys(df, ["k"])
    assert dup.first().n == 40_000
    assert exchanged_rows(dup) <= 8


@pytest.mark.parametrize("hot_rows", [1 << 16, 100])
def test_keys_are_counted_alike_with_and_without_combining(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(keys, "HOT_ROWS", hot_rows)
    n = F.col("id")
    df = spark.range(6_000, numPartitions=4).select(
        F.when(n % 3 == 0, "hot").when(n % 100 != 1, (n % 5000).cast("string")).alias("a"),
        F.when(n % 7 != 0, n % 2).alias("b"),
    )
    plain = df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, count_keys(df, ["a", "b"]).collect())) == sorted(map(str, plain.collect()))
    assert count_keys(df.limit(0), ["a"]).count() == 0


def test_a_hot_key_among_single_ones_is_combined(spark, monkeypatch):
    monkeypatch.setattr(keys, "HOT_ROWS", 1_000)
    n = F.col("id")
    df = spark.range(40_000, numPartitions=8).select(F.when(n < 100, n).otherwise(-1).alias("k"))
    assert {r.n for r in count_keys(df, ["k"]).collect()} == {1, 39_900}
    # Cells, keys that stand alone, the hot key of every map task, and the sum of all rows.
    assert exchanged_rows(count_keys(df, ["k"])) <= 1_000


def test_the_seller_book_is_not_held_by_split(star, hot_star, monkeypatch):
    """Nearly every line is a pair of its own; a pair with many lines is combined first."""
    assert "REPARTITION_BY_NUM" in final_plan(builders.build_seller_book(star.lines))
    monkeypatch.setattr(keys, "HOT_ROWS", 1_000)
    book = builders.build_seller_book(hot_star.lines)
    assert book.agg(F.sum("line_count")).first()[0] == ROWS
    assert exchanged_rows(book) < ROWS


@pytest.mark.parametrize("name", ["dq_duplicate_keys", "dq_duplicate_leads"])
def test_keys_that_hardly_repeat_are_not_held_by_split(star, name):
    """Partitions of a planned number: merged by bytes they would be too many keys for a task."""
    assert "REPARTITION_BY_NUM" in final_plan(METRICS[name].run(star))


@pytest.mark.parametrize("name", sorted(METRICS))
def test_no_cross_join_or_python(star, name):
    plan = final_plan(METRICS[name].run(star))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert banned not in plan, banned


@pytest.mark.parametrize("name", sorted(METRICS))
def test_single_task_steps_see_aggregated_rows_only(hot_star, name):
    """400 days is the widest grain that is ever ordered or summed in one task."""
    for partitioning, rows in exchanges(METRICS[name].run(hot_star)):
        if "SinglePartition" in partitioning:
            assert rows <= 400, (name, rows)


def test_filters_and_columns_reach_the_scan(hot_star):
    plan = final_plan(METRICS["monthly_gmv"].run(hot_star))
    assert "PushedFilters: [Not(In(order_status, [canceled,unavailable]))" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "customer_state" not in scan and "review_score" not in scan
    # seven of the order book's columns are enough
    assert json.dumps(scan).count(":") < 40


def test_volume_snapshot_needs_no_cross_join(star):
    assert "Join" not in final_plan(volume_snapshot(star.clean))


def test_partition_numbers_follow_the_input():
    assert sizing_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert sizing_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    assert sizing_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"


@pytest.fixture()
def shuffled_joins(spark):
    """Thresholds lowered to the size of the test, broadcasts off: what a cluster does with
    tables too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_order_product_and_seller_are_split_in_the_fact_build(hot_star, shuffled_joins):
    clean, dims = hot_star.clean, hot_star.dims
    book = builders.build_line_book(clean["order_items"], hot_star.frame, dims)
    plan = final_plan(book)
    assert plan.count("SortMergeJoin(skew=true)") == 3
    assert book.count() == ROWS


def test_hot_parents_are_split_while_cleaning(spark, hot_star, shuffled_joins):
    from tradewind.operators.cleaning import clean_order_items

    text = [F.col(c).cast("string").alias(c) for c in hot_star.clean["order_items"].columns]
    raw = hot_star.clean["order_items"].select(*text)
    parents = {n: hot_star.clean[n] for n in ("orders", "products", "sellers")}
    done = clean_order_items(raw, **parents)
    assert final_plan(done.rows).count("SortMergeJoin(skew=true)") == 3
    assert final_plan(done.rejects).count("SortMergeJoin(skew=true)") == 3
    assert done.rows.count() == ROWS and done.rejects.count() == 0
