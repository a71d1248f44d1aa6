from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest

from tests.market import NL_TEXT, RAW, raw_frames
from tradewind.operators import cleaning
from tradewind.operators.cleaning import clean_all, clean_table, latest_per_key, superseded_rows
from tradewind.sources.contracts import CLEAN_TABLES
from tradewind.sources.tables import materialize_table


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_all(raw_frames(spark))


def listed(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_customers(cleaned):
    got = {r.customer_id: r for r in cleaned[0]["customers"].collect()}
    assert set(got) == {"c1", "c2", "c3", "c4", "c8"}
    assert got["c1"].customer_city == "Santa Barbara D'Oeste"
    assert got["c3"].customer_city == "Embu-Guacu"
    assert got["c4"].customer_city == ""
    assert got["c8"].customer_city == "Tab\tHere"
    assert (got["c1"].customer_zip_code_prefix, got["c2"].customer_zip_code_prefix) == (123, None)
    assert [got[c].customer_state for c in ("c1", "c2")] == ["SP", "RJ"]


def test_seller_city_is_lower_case(cleaned):
    assert listed(cleaned[0]["sellers"], "seller_city") == [("idle",), ("rio",), ("sao paulo",)]


def test_categories_are_trimmed_and_distinct(cleaned):
    assert listed(cleaned[0]["category_translation"], "*") == [
        ("livros", "books"),
        ("moveis", "furniture"),
    ]


def test_products_keep_blank_category_as_null(cleaned):
    got = {r.product_id: r for r in cleaned[0]["products"].collect()}
    assert set(got) == {"p1", "p2", "p3", "p4"}
    assert got["p4"].product_category_name is None
    assert got["p2"].product_description_length is None


def test_geolocation_points_may_repeat_and_get_dense_ids(cleaned):
    got = cleaned[0]["geolocation"].collect()
    assert sorted(r.geolocation_id for r in got) == [1, 2]
    assert {r.geolocation_lat for r in got} == {Decimal("-23.545679")}


def test_items_clamp_default_and_resolve_parents(cleaned):
    got = {(r.order_id, r.order_item_id): r for r in cleaned[0]["order_items"].collect()}
    assert set(got) == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o4", 1), ("o5", 1)}
    assert got["o1", 2].price == Decimal("50.01")  # half away from zero
    assert (got["o3", 1].price, got["o3", 1].freight_value) == (Decimal("0.00"),) * 2
    assert got["o4", 1].price == Decimal("0.00")
    assert got["o1", 2].shipping_limit_date is None


def test_payments(cleaned):
    assert listed(cleaned[0]["order_payments"], "order_id", "payment_sequential", "payment_type",
                  "payment_installments", "payment_value") == [
        ("o1", 1, "credit_card", 8, Decimal("150.50")),
        ("o1", 2, "voucher", 1, Decimal("10.00")),
        ("o2", 1, "slip", 0, Decimal("0.00")),
        ("o4", 1, "slip", 2, Decimal("0.00")),
    ]


def test_reviews_clamp_scores_and_keep_the_latest_copy(cleaned):
    got = {r.review_id: r for r in cleaned[0]["order_reviews"].collect()}
    assert {k: (r.order_id, r.review_score) for k, r in got.items()} == {
        "r1": ("o1", 1),
        "r2": ("o1", 4),
        "r3": ("o3", 5),
        "r4": ("o4", 3),
        "r5": ("o5", 5),
        "r6": ("o5", 1),
    }
    assert got["r1"].review_comment_title is None
    assert got["r1"].review_comment_message == NL_TEXT


def test_leads_and_deals(cleaned):
    assert listed(cleaned[0]["qualified_leads"], "mql_id", "origin") == [
        ("m1", "organic"),
        ("m2", "unknown"),
        ("m3", "unknown"),
        ("m4", "paid"),
    ]
    deals = {r.mql_id: r for r in cleaned[0]["closed_deals"].collect()}
    assert set(deals) == {"m1", "m2", "m3"}
    assert [deals["m1"].has_company, deals["m1"].has_gtin] == [True, False]
    assert [deals["m2"].has_company, deals["m2"].has_gtin] == [None, None]
    assert deals["m3"].seller_id is None
    assert deals["m1"].declared_monthly_revenue == Decimal("10.10")


def test_every_row_is_kept_or_quarantined(cleaned):
    rows, quarantine = cleaned
    refused = Counter(r.table_name for r in quarantine.collect())
    for name, (_, data) in RAW.items():
        if name == "category_translation":
            continue  # equal rows are merged there
        assert rows[name].count() + refused[name] == len(data), name


def test_reject_reasons(cleaned):
    got = Counter((r.table_name, r.reason) for r in cleaned[1].collect())
    assert got == {
        ("customers", "malformed_customer_zip_code_prefix"): 2,
        ("customers", "blank_customer_id"): 1,
        ("customers", "too_long_customer_state"): 1,
        ("category_translation", "blank_product_category_name_english"): 1,
        ("products", "malformed_product_name_lenght"): 1,
        ("geolocation", "blank_geolocation_zip_code_prefix"): 1,
        ("geolocation", "malformed_geolocation_lat"): 1,
        ("orders", "malformed_order_purchase_timestamp"): 1,
        ("orders", "blank_customer_id"): 1,
        ("order_items", "orphan_orders"): 1,
        ("order_items", "orphan_products"): 1,
        ("order_items", "orphan_sellers"): 1,
        ("order_items", "malformed_order_item_id"): 1,
        ("order_items", "malformed_price"): 2,
        ("order_payments", "orphan_orders"): 1,
        ("order_reviews", "blank_review_score"): 1,
        ("order_reviews", "orphan_orders"): 1,
        ("order_reviews", "superseded_review_id"): 2,
        ("qualified_leads", "blank_first_contact_date"): 1,
        ("qualified_leads", "malformed_first_contact_date"): 1,
        ("closed_deals", "orphan_qualified_leads"): 1,
        ("closed_deals", "blank_won_date"): 1,
    }


def test_quarantine_keeps_the_raw_row(cleaned):
    raw = cleaned[1].where("reason = 'orphan_sellers'").first().raw_row
    assert '"seller_id":"zz"' in raw and '"order_item_id":"4"' in raw


def test_older_copies_of_a_review_are_quarantined(cleaned):
    raws = cleaned[1].where("reason = 'superseded_review_id'").collect()
    assert sorted(r.raw_row[:35] for r in raws) == [
        '{"review_id":"r3","order_id":"o2","',
        '{"review_id":"r4","order_id":"o5","',
    ]


def test_all_but_one_row_of_a_key_are_superseded(spark, rows):
    from pyspark.sql import functions as F

    data = [("a", 1, None)] * 40 + [("a", 2, "x"), ("a", 2, None), ("b", 1, "y"), (None, 3, "z"), ("c", 5, "c")]
    df = rows("k string, v int, raw string", [*data, ("c", 5, "c")]).repartition(4)
    got = Counter(tuple(r) for r in superseded_rows(df, ["k"], [F.desc("v")]).collect())
    assert got == {("a", 1, None): 40, ("a", 2, None): 1, ("c", 5, "c"): 1}
    assert superseded_rows(df.limit(0), ["k"], [F.desc("v")]).count() == 0


def test_copies_of_a_hot_key_do_not_meet_in_one_task(spark):
    from pyspark.sql import functions as F

    # A third of all rows are equal copies of one key.
    df = spark.range(30_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'hot', string(id div 2)) AS k", "if(id % 3 = 0, 1, id % 2) AS v"
    )
    older = superseded_rows(df, ["k"], [F.desc("v")])
    want = df.count() - df.select("k").distinct().count()
    assert older.count() == want
    plan = older._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_parent_does_not_multiply_rows(spark, rows):
    items = raw_frames(spark)["order_items"]
    parents = {
        "orders": rows("order_id string", [("o1",), ("o1",)]),
        "products": rows("product_id string", [("p1",)] * 3),
        "sellers": rows("seller_id string", [("s1",)] * 2),
    }
    done = clean_table(items, CLEAN_TABLES["order_items"], parents)
    assert listed(done.rows, "order_id", "order_item_id") == [("o1", 1)]


@pytest.mark.parametrize("name", ["orders", "order_items", "order_payments", "order_reviews", "closed_deals"])
def test_children_by_lost_keys_equal_those_by_parents(spark, name, tmp_path):

    raw = raw_frames(spark)
    lazy, _ = clean_all(raw)
    known = {n: materialize_table(lazy[n], f"{tmp_path}/{n}") for n in ("customers", "products", "sellers", "orders", "qualified_leads")}
    # Once more with parents of which one holds nothing, or that hold their rows twice.
    resolved = [r.parent for r in CLEAN_TABLES[name].references if r.resolve]
    empty = {**known, resolved[0]: known[resolved[0]].limit(0)}
    twice = {**known, **{p: known[p].unionAll(known[p]) for p in resolved}}
    for parents in (known, empty, twice):
        plain = cleaning.clean_child(raw, name, parents)
        got = cleaning.clean_child(raw, name, parents, store_lost=True)
        for kind in ("rows", "rejects"):
            found, wanted = (Counter(map(str, getattr(c, kind).collect())) for c in (got, plain))
            assert found == wanted


def test_rows_look_up_lost_keys_without_an_exchange(spark, rows):
    """The parents are too large to broadcast, what is lost is not."""
    names = [f.source for f in CLEAN_TABLES["order_items"].fields]
    values = {"order_id": "concat('o', id)", "order_item_id": "'1'", "product_id": "concat('p', id % 900)",
              "seller_id": "concat('s', id % 70)", "price": "'1.00'", "freight_value": "'1.00'"}
    raw = {"order_items": spark.range(2000).selectExpr(*[f"{values.get(n, 'cast(NULL AS string)')} AS `{n}`" for n in names])}
    known = {
        "orders": spark.range(5, 9000).selectExpr("concat('o', id) AS order_id"),
        "products": spark.range(3, 9000).selectExpr("concat('p', id) AS product_id"),
        "sellers": spark.range(1, 9000).selectExpr("concat('s', id) AS seller_id"),
    }
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key in settings:
            spark.conf.set(key, "10000")
        done = cleaning.clean_child(raw, "order_items", known, store_lost=True)
        assert (done.rows.count(), done.rejects.count()) == (1961, 39)
        for df in (done.rows, done.rejects):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_latest_per_key_limits_before_the_exchange(spark, rows):
    from pyspark.sql import functions as F

    day = datetime(2020, 1, 1)
    df = rows("k string, v int, at timestamp_ntz", [("a", i, day) for i in range(50)])
    kept = latest_per_key(df, ["k"], [F.desc("at"), F.asc("v")])
    assert [tuple(r)[:2] for r in kept.collect()] == [("a", 0)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_values_are_parsed_once_and_json_is_made_behind_the_joins(spark, rows):
    parents = {
        "orders": rows("order_id string", [("o1",)]),
        "products": rows("product_id string", [("p1",)]),
        "sellers": rows("seller_id string", [("s1",)]),
    }
    done = clean_table(raw_frames(spark)["order_items"], CLEAN_TABLES["order_items"], parents)
    for df in (done.rows, done.rejects):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("try_cast") <= sum(f.type != "string" for f in CLEAN_TABLES["order_items"].fields)
    plan = done.rejects._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "structstojson" in plan and "structstojson" not in plan[plan.index("join") :]
    assert "structstojson" not in done.rows._jdf.queryExecution().optimizedPlan().toString().lower()


def test_text_rules_as_sql_equal_those_as_columns(spark, rows):
    from pyspark.sql import functions as F

    from tradewind.functions import text

    words = ["santa barbara d'oeste", "embu-guacu", " ", None, "Yes", " T ", "0", "maybe", "tab\there", "é-à b"]
    df = rows("c string", [(w,) for w in words])
    for name in ("blank_to_null", "title_words", "truth_value"):
        column = getattr(text, name)(F.col("c"))
        sql = F.expr(getattr(text, f"{name}_sql")("c"))
        got = df.select(column.alias("a"), sql.alias("b")).collect()
        assert all(r.a == r.b for r in got), name
