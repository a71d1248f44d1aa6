from __future__ import annotations

import dataclasses
from datetime import date
from decimal import Decimal as D

import pytest

from tests.market import raw_frames, write_csv
from tradewind import run
from tradewind.operators import integrity, star as builders
from tradewind.operators.cleaning import clean_all
from tradewind.operators.star import open_star
from tradewind.plans import customer, delivery, funnel, growth, kpi, product, revenue, seller
from tradewind.plans.catalog import METRICS
from tradewind.plans.suite import run_metric_suite, suite_summary
from tradewind.run import run_all
from tradewind.sources.contracts import CLEAN_TABLES, STAR_TABLES
from tradewind.sources.tables import layer_paths, read_layer


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    rows, _ = clean_all(raw_frames(spark))
    return builders.build_star(spark, rows, str(tmp_path_factory.mktemp("star")))


@pytest.fixture(scope="module")
def empty_star(spark, tmp_path_factory):
    nothing = {n: df.limit(0) for n, df in raw_frames(spark).items()}
    rows, _ = clean_all(nothing)
    return builders.build_star(spark, rows, str(tmp_path_factory.mktemp("empty")))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_order_dimension(star):
    got = by(star.dims["dim_order"], "order_id")
    late = got["o1"]
    assert (late.delivery_days, late.is_late_delivery, late.delay_days) == (15, True, 0)
    assert got["o3"].delivery_days == -1
    assert (got["o4"].is_late_delivery, got["o4"].delivery_days) == (None, None)
    assert (got["o5"].is_late_delivery, got["o5"].delivery_days) == (None, 38)


def test_date_dimension_covers_every_day(star):
    days = star.dims["dim_date"].orderBy("full_date").collect()
    assert (days[0].full_date, days[-1].full_date) == (date(2020, 1, 5), date(2020, 6, 2))
    assert len(days) == (date(2020, 6, 2) - date(2020, 1, 5)).days + 1
    first = days[0]
    assert (first.date_key, first.day_of_week, first.day_name) == (20200105, 7, "Sun")
    assert (first.week_of_year, first.month_name, first.is_weekend) == (1, "Jan", True)


def test_product_dimension_names_missing_translations(star):
    got = by(star.dims["dim_product"], "product_id")
    assert [got[p].product_category_name_english for p in ("p1", "p2", "p3", "p4")] == [
        "books",
        "furniture",
        "untranslated",
        "untranslated",
    ]


def test_payment_dimension(star):
    got = by(star.dims["dim_payment"], "order_id")
    first = got["o1"]
    assert (first.primary_payment_type, first.payment_count) == ("credit_card", 2)
    assert (first.total_payment_value, first.max_installments) == (D("160.50"), 8)
    assert set(got) == {"o1", "o2", "o4"}


def test_review_dimension_keeps_the_latest_and_breaks_ties(star):
    got = by(star.dims["dim_review"], "order_id")
    assert {o: r.review_id for o, r in got.items()} == {
        "o1": "r2",
        "o3": "r3",
        "o4": "r4",
        "o5": "r5",  # both undated: the smaller id
    }
    assert (got["o1"].has_comment, got["o3"].has_comment) == (False, True)


def test_fact_matches_its_contract(star):
    fact = star.fact
    assert fact.columns == [f.name for f in STAR_TABLES["fact_order_items"].fields]
    assert fact.count() == star.clean["order_items"].count() == 6
    line = fact.where("order_id = 'o1' and order_item_id = 2").first()
    assert (line.price, line.item_contribution) == (D("50.01"), D("-9.99"))
    assert line.payment_sk is not None
    o5 = fact.where("order_id = 'o5'").first()
    assert o5.payment_sk is None and o5.review_sk is not None
    assert sorted(r.fact_sk for r in fact.collect()) == [1, 2, 3, 4, 5, 6]


def test_books_agree(star):
    lines = star.lines.groupBy("order_id").count().collect()
    book = by(star.orders, "order_id")
    assert {r.order_id: r["count"] for r in lines} == {o: r.line_count for o, r in book.items()}


def test_clean_data_passes_and_dirty_data_fails_integrity(spark, star):
    own = star.tables()
    for check in (integrity.check_primary_keys, integrity.check_unique,
                  integrity.check_foreign_keys, integrity.check_not_null):
        assert {r.violations for r in check(own, STAR_TABLES).collect()} == {0}, check
    raw = raw_frames(spark)
    bounds = integrity.check_type_bounds(raw, CLEAN_TABLES).where("violations > 0").collect()
    assert {(r.table_name, r.column_name) for r in bounds} == {
        ("customers", "customer_state"),
        ("order_items", "price"),
        ("geolocation", "geolocation_lat"),
    }


def test_statuses_are_dropped_from_monthly_but_not_yearly(star):
    monthly = revenue.monthly_gmv(star).collect()
    assert [(r.month_name, r.orders, r.gmv) for r in monthly] == [
        ("Jan", 1, D("150.01")),
        ("Mar", 3, D("200.00")),
    ]
    assert monthly[1].mom_gmv_growth_pct == D("33.32")
    assert monthly[1].running_gmv == D("350.01")
    assert revenue.yearly_gmv(star).first().gmv == D("380.01")


def test_growth_over_a_zero_month_is_null(star, spark):
    orders = star.orders.withColumn("revenue_cents", star.orders.revenue_cents * 0)
    zero = dataclasses.replace(star, orders=orders)
    assert {r.mom_pct for r in revenue.demo_monthly_mom(zero).collect()} == {None}


def test_rolling_frame_counts_rows_not_days(star):
    rows = revenue.rolling_7d(star, rows=2).collect()
    assert [r.full_date for r in rows] == [
        date(2020, 1, 5), date(2020, 3, 1), date(2020, 3, 10), date(2020, 3, 31), date(2020, 4, 2)
    ]
    assert [r.orders_7d_rolling for r in rows] == [1, 2, 2, 2, 2]
    assert rows[1].gmv_7d_avg == D("175.01")  # 175.005 away from zero


def test_categories(star):
    top = product.top_categories(star).collect()
    assert [(r.category, r.units_sold, r.revenue_rank) for r in top] == [
        ("books", 3, 1), ("furniture", 1, 2), ("untranslated", 2, 3)
    ]
    assert sum(r.pct_of_total_revenue for r in top) == D("100.00")
    # books alone reach 86.84 %: the crossing category is included
    assert [r.category for r in product.pareto_categories(star).collect()] == ["books"]
    assert product.kpi_top_category(star).first().category == "books"
    quality = product.category_delivery_quality(star, min_lines=1).collect()
    assert "untranslated" not in {r.category for r in quality}


def test_price_bands_use_lower_bounds(star):
    got = {r.price_band: r["items"] for r in product.price_bands(star).collect()}
    assert got == {"A) < 50": 3, "B) 50-99": 1, "C) 100-199": 1, "D) 200-499": 1}


def test_sellers(star):
    top = seller.top_sellers(star, min_orders=1).collect()
    assert [(r.seller_id, r.orders, r["items"], r.gmv, r.gmv_rank) for r in top] == [
        ("s1", 3, 3, D("300.00"), 1), ("s2", 3, 3, D("80.01"), 2)
    ]
    states = {r.seller_state: r for r in seller.seller_state_contribution(star).collect()}
    assert (states["MG"].sellers, states["MG"].items_sold, states["MG"].gmv) == (1, 0, None)
    weak = seller.risky_sellers(star, min_orders=1, max_review="4.5").collect()
    assert [(r.seller_id, r.avg_review) for r in weak] == [("s2", D("4.00"))]


def test_customers(star):
    kinds = by(customer.repeat_vs_one_time(star), "customer_type")
    assert (kinds["repeat"].customers, kinds["repeat"].total_revenue) == (2, D("380.01"))
    assert (kinds["one_time"].customers, kinds["one_time"].pct_customers) == (1, D("33.33"))
    assert customer.customers_without_reviews(star).first()[0] == 1
    # ann bought from two states and appears under both
    top = customer.top_customers(star).collect()
    assert [(r.customer_unique_id, r.customer_state) for r in top[:2]] == [("ann", "RJ"), ("ann", "SP")]
    assert growth.repeat_90d(star).first()[0] == 2


def test_recency_option_turns_the_scores(star):
    default = by(customer.rfm_scores(star, tiles=3), "customer_unique_id")
    turned = by(customer.rfm_scores(star, recency_best_high=True, tiles=3), "customer_unique_id")
    assert [default[p].r_score for p in ("cat", "bob", "ann")] == [1, 2, 3]
    assert [turned[p].r_score for p in ("cat", "bob", "ann")] == [3, 2, 1]


def test_delivery(star):
    one = delivery.delivery_summary(star).first()
    assert (one.delivered_orders, one.late_delivery_pct) == (3, D("25.00"))
    assert one.avg_delay_when_late == D("0.00")
    assert delivery.kpi_on_time(star).first()[0] == D("66.67")
    buckets = delivery.delivery_buckets(star).collect()
    assert [(r.delivery_bucket, r.orders) for r in buckets] == [
        ("0-3 days", 2), ("15-30 days", 1), ("30+ days", 1)
    ]
    flags = by(delivery.late_vs_reviews(star), "delivery_flag")
    assert (flags["Late"].avg_score, flags["On Time"].avg_score) == (D("4.00"), D("5.00"))


def test_cohorts(star):
    got = {(r.cohort_month, r.month_number): r for r in growth.cohort_retention(star).collect()}
    assert {k[1]: r.retention_pct for k, r in got.items() if k[0] == date(2020, 1, 1)} == {
        0: D("100.00"), 2: D("100.00")
    }
    assert {k[1]: r.retention_pct for k, r in got.items() if k[0] == date(2020, 3, 1)} == {
        0: D("100.00"), 1: D("50.00")
    }
    monthly = [tuple(r)[1:] for r in growth.new_vs_returning(star).collect()]
    assert monthly == [(1, 0, 1), (2, 1, 3), (0, 1, 1)]


def test_snapshot(star):
    got = kpi.kpi_snapshot(star).first()
    assert tuple(got)[:5] == (4, 3, 2, D("350.01"), D("259.01"))
    assert got.avg_review_score == D("4.00")  # 4, 4, none, 5, 3 over lines


def test_funnel(star):
    assert tuple(funnel.funnel_conversion(star).first()) == (4, 3, D("75.00"))
    origins = by(funnel.funnel_by_origin(star), "origin")
    assert (origins["paid"].closed, origins["paid"].conversion_pct) == (0, D("0.00"))
    kinds = by(funnel.declared_revenue_by_type(star), "business_type")
    assert kinds["unknown"].avg_positive_declared_revenue is None
    assert kinds["reseller"].avg_positive_declared_revenue == D("10.10")
    # two deals of s1: counted once per group, amounts repeated
    gmv = {(r.business_type, r.lead_origin): r for r in funnel.acquired_seller_gmv(star).collect()}
    assert {k: (r.acquired_sellers, r.marketplace_orders, r.marketplace_gmv) for k, r in gmv.items()} == {
        ("reseller", "organic"): (1, 3, D("300.00")),
        (None, "unknown"): (1, 3, D("300.00")),
    }
    assert [tuple(r) for r in funnel.time_to_close(star).collect()] == [
        ("0-7 days", 1), ("31-90 days", 1)
    ]
    assert {r.origin: r.attributed_gmv for r in funnel.origin_gmv(star).collect()} == {
        "organic": D("300.00"), "unknown": D("300.00")
    }


def test_every_metric_runs_over_nothing(empty_star):
    for name, metric in METRICS.items():
        rows = metric.run(empty_star).collect()
        assert len(rows) <= 4, name
    one = METRICS["kpi_snapshot"].run(empty_star).first()
    assert (one.total_orders, one.unique_customers, one.total_gmv) == (0, 0, None)
    assert METRICS["dq_null_orders"].run(empty_star).first().null_order_pk is None


def test_repeated_primary_keys_stop_the_build(spark, tmp_path):
    raw = raw_frames(spark)
    twice = {**raw, "orders": raw["orders"].unionByName(raw["orders"].where("order_id = 'o1'"))}
    rows, _ = clean_all(twice)
    assert rows["order_items"].count() == 6  # a repeated parent repeats no line
    with pytest.raises(ValueError, match="orders: 1"):
        integrity.require_primary_keys(rows, CLEAN_TABLES)


def test_suite_isolates_failures(spark, star, tmp_path, monkeypatch):
    from tradewind.plans import catalog, suite

    def broken(_star):
        raise ValueError("no such column")

    bad = catalog.Metric("kpi_on_time", "business", broken, "star")
    monkeypatch.setitem(suite.METRICS, "kpi_on_time", bad)
    log = run_metric_suite(spark, star, str(tmp_path), ["kpi_on_time", "repeat_90d"])
    got = by(log, "metric")
    assert got["kpi_on_time"].status == "error" and "no such column" in got["kpi_on_time"].error
    assert got["repeat_90d"].status == "ok"
    assert got["repeat_90d"].preview == ['{"customers_with_90d_repeat":2}']
    assert got["kpi_on_time"].row_count is None and got["kpi_on_time"].preview is None
    assert got["repeat_90d"].row_count == 1 and got["repeat_90d"].error is None
    assert tuple(suite_summary(log).first()) == (1, 2)


def test_suite_runs_a_plan_once_and_previews_its_order(spark, star, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tradewind.plans import catalog, suite

    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        ran.add(1)
        return x

    def ordered(_star):
        return spark.range(0, 1000, numPartitions=7).select(seen("id").alias("x")).orderBy(F.desc("x"))

    monkeypatch.setitem(suite.METRICS, "kpi_on_time", catalog.Metric("kpi_on_time", "business", ordered, "star"))
    log = run_metric_suite(spark, star, str(tmp_path), ["kpi_on_time"], preview_rows=3).first()
    assert (log.status, log.row_count) == ("ok", 1000)
    assert log.preview == ['{"x":999}', '{"x":998}', '{"x":997}']
    stored = spark.read.parquet(f"{tmp_path}/results/kpi_on_time").orderBy(suite.PLACE)
    assert [r.x for r in stored.collect()] == list(range(999, -1, -1))
    # Once for the result; a sort reads its input a second time to find the ranges.
    assert ran.value <= 2000


def test_star_and_limits_are_part_of_the_gate(spark, star):
    from pyspark.sql import functions as F

    from tradewind.sources.contracts import STAR_TABLES

    integrity.require_constraints(star.tables(), STAR_TABLES)
    name, field = next((n, f) for n, c in STAR_TABLES.items() for f in c.fields if f.limit is not None)
    long_text = F.lit("x" * (field.limit + 1))
    broken = star.tables() | {name: star.tables()[name].withColumn(field.name, long_text)}
    with pytest.raises(ValueError, match=f"limits: {name} {field.name}"):
        integrity.require_constraints(broken, STAR_TABLES)
    lost = star.tables() | {"dim_seller": star.tables()["dim_seller"].limit(0)}
    with pytest.raises(ValueError, match="references: fact_order_items dim_seller"):
        integrity.require_constraints(lost, STAR_TABLES)


def test_csv_to_insights_and_again(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    write_csv(raw)
    first = run_all(spark, str(raw), str(out), database="wholerun")
    assert tuple(suite_summary(first.log).first()) == (59, 59)
    document = first.insights.first()
    assert document.snapshot.total_gmv == D("350.01")
    assert [r.category for r in document.top_categories][:1] == ["books"]
    keys = sorted(tuple(r) for r in first.star.fact.collect())
    # The star, the clean layer and the BI tables of the version are found by its root alone.
    root = f"{out}/clean"
    opened = open_star(spark, root)
    assert sorted(tuple(r) for r in opened.fact.collect()) == keys
    assert opened.lines.count() == first.star.lines.count()
    bi = read_layer(spark, root, "bi")
    assert {"fact_order_items", "dim_review", "closed_deals"} <= set(bi)
    assert sorted(tuple(r) for r in spark.table("wholerun.fact_order_items").collect()) == keys

    # A run that dies behind the star leaves all three on the old version.
    before = layer_paths(spark, root, "star"), layer_paths(spark, root, "bi"), layer_paths(spark, root)
    with monkeypatch.context() as patched:
        patched.setattr(run, "require_all_lines", lambda _: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_all(spark, str(raw), str(out), database="wholerun")
    assert before == (layer_paths(spark, root, "star"), layer_paths(spark, root, "bi"), layer_paths(spark, root))
    assert sorted(tuple(r) for r in open_star(spark, root).fact.collect()) == keys

    again = run_all(spark, str(raw), str(out), partition_by_month=True, database="wholerun")
    assert layer_paths(spark, root, "bi") != before[1]
    assert sorted(tuple(r) for r in spark.table("wholerun.fact_order_items").select(bi["fact_order_items"].columns).collect()) == keys
    spark.sql("DROP DATABASE wholerun CASCADE")
    assert sorted(tuple(r) for r in again.star.fact.collect()) == keys
    assert again.quarantine.count() == first.quarantine.count() == 25


def test_a_metric_stores_only_what_it_reads(spark, star, tmp_path):
    """Dimensions and books that a plan does not read are not written."""
    from tradewind.plans.delivery import demo_late_ratings, kpi_on_time

    lazy = builders.StarOnUse(star.clean, str(tmp_path))
    stored = lambda: {p.name for p in tmp_path.iterdir()}
    assert kpi_on_time(lazy).collect() == kpi_on_time(star).collect()
    assert stored() == {"dim_order"}
    got, want = (sorted(demo_late_ratings(s).collect()) for s in (lazy, star))
    assert got == want
    assert stored() == {"dim_customer", "dim_order", "dim_payment", "dim_review", "order_frame"}
    whole = lazy.whole()
    assert stored() == set(builders.star_table_names())
    assert whole.sellers.count() == star.sellers.count()


def test_metrics_over_lines_do_without_the_numbering(spark, star, tmp_path):
    """Lines are numbered for readers of the fact alone; results are the same."""
    lazy = builders.StarOnUse(star.clean, str(tmp_path))
    for name in ("volume_below_avg_price", "price_bands", "cohort_retention", "kpi_snapshot", "top_sellers"):
        assert sorted(METRICS[name].plan(lazy).collect()) == sorted(METRICS[name].plan(star).collect())
    stored = {p.name for p in tmp_path.iterdir()}
    assert "metric_lines" in stored and "line_book" not in stored
    builders.require_all_lines(lazy)
    assert sorted(lazy.fact.collect()) == sorted(star.fact.collect())
    assert lazy.lines.columns == star.lines.columns
