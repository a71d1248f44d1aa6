from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.operators.numbering import assign_surrogate_keys, global_ntile, number_rows


def test_keys_are_dense_unique_and_reproducible(spark):
    base = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k"))
    one = assign_surrogate_keys(base, ["k"], "sk").collect()
    assert sorted(r.sk for r in one) == list(range(1, 5001))
    shuffled = base.repartition(37, F.rand(3))
    other = assign_surrogate_keys(shuffled, ["k"], "sk").collect()
    assert {r.k: r.sk for r in one} == {r.k: r.sk for r in other}


def test_keys_may_be_text_or_compound_and_counted_from_elsewhere(spark, rows):
    df = rows("a string, b int, v int", [(f"o{i % 40}", i // 40, i) for i in range(400)])
    got = assign_surrogate_keys(df, ["a", "b"], "sk", keys_only=df.select("a", "b")).collect()
    assert sorted(r.sk for r in got) == list(range(1, 401))
    assert got[0].asDict().keys() == {"sk", "a", "b", "v"}


def test_keys_have_no_single_task_stage_over_the_rows(spark):
    df = assign_surrogate_keys(spark.range(10).withColumnRenamed("id", "k"), ["k"], "sk")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the only single partition holds the slice sizes
    assert plan.count("SinglePartition") == 1
    assert plan.index("hashpartitioning(_slice") < plan.index("SinglePartition")


@pytest.mark.parametrize("n,tiles", [(0, 5), (3, 5), (5, 5), (1003, 5), (997, 4)])
def test_ntile_equals_the_native_window(spark, n, tiles):
    rng = random.Random(n)
    # most rows share one value, as purchase frequencies do
    data = [(i, 1 if rng.random() < 0.9 else rng.randrange(9), date(2020, 1, 1 + i % 28))
            for i in range(n)]
    df = spark.createDataFrame(data, "id int, v int, d date").repartition(6)
    for order in ([F.asc("v"), F.asc("id")], [F.desc("d"), F.asc("id")]):
        got = global_ntile(df, order, tiles, "t").collect()
        want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order))).collect()
        assert {r.id: r.t for r in got} == {r.id: r.t for r in want}
        assert len(got) == n


def test_ntile_sort_cuts_through_a_run_of_equal_values(spark):
    df = spark.range(20_000, numPartitions=8).select("id", F.lit(1).alias("v"))
    sizes = (
        df.orderBy("v", "id").groupBy(F.spark_partition_id()).count().select("count").collect()
    )
    assert max(r[0] for r in sizes) < 20_000 / 2


def test_repeated_rows_get_distinct_numbers(spark, rows):
    df = rows("a string", [("x",)] * 30 + [("y",)] * 5).repartition(4)
    got = number_rows(df, "id").collect()
    assert sorted(r.id for r in got) == list(range(1, 36))


def test_rows_that_repeat_often_cross_the_exchange_once(spark, monkeypatch):
    from tests.test_scale import exchanges
    from tradewind.operators import numbering

    monkeypatch.setattr(numbering, "_UNFOLDED", 1000)
    hot = spark.range(50_000, numPartitions=8).selectExpr("if(id % 3 = 0, NULL, id % 5) AS a", "'x' AS b")
    numbered = number_rows(hot, "id")
    rows = numbered.collect()
    assert sorted(r.id for r in rows) == list(range(1, 50_001))
    assert sum(r.a is None for r in rows) == hot.where("a IS NULL").count()
    assert max(n for _, n in exchanges(numbered)) <= 8 * 6


def test_building_plans_of_all_tables_starts_no_job(spark):
    from tests.market import raw_frames
    from tradewind.operators.cleaning import clean_all

    raw = raw_frames(spark)
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        clean_all(raw)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_slices_travel_as_numbers_in_the_order_of_their_digits(spark):
    from tradewind.operators.numbering import key_slice

    rows = spark.range(500).select(F.col("id"), key_slice(["id"]).alias("s"))
    digits = F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 4).alias("d")
    assert dict(rows.dtypes)["s"] == "int"
    found = rows.select("s", digits).collect()
    assert all(r.s == int(r.d, 16) for r in found)
