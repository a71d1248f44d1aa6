"""What crosses an exchange, and how long shuffled rows stay on disk."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_scale import exchanges, hot_star, star  # noqa: F401
from tradewind.operators import keys, star as builders
from tradewind.operators.numbering import assign_surrogate_keys
from tradewind.sources.tables import materialize_table, shuffles_dropped

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    dirs = [Path(str(d)) for d in blocks.diskBlockManager().localDirs()]
    return {str(f) for d in dirs for f in d.rglob("shuffle_*.data")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(200_000, numPartitions=4).groupBy((F.col("id") % 90_000).alias("k")).count()
    stored = materialize_table(rows, str(tmp_path / "t"))
    deadline = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
    assert stored.agg(F.sum("count")).first()[0] == 200_000
    assert rows.count() == 90_000  # the plan can run again


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_setting_of_the_session_comes_back(spark, own):
    before = spark.conf.get(SETTING, None)
    try:
        spark.conf.unset(SETTING) if own is None else spark.conf.set(SETTING, own)
        first, second = shuffles_dropped(spark), shuffles_dropped(spark)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)  # writers side by side end in any order
        assert spark.conf.get(SETTING) == "true"
        second.__exit__(None, None, None)
        assert spark.conf.get(SETTING, None) == own
    finally:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)


def test_lines_are_dealt_to_the_seller_book_by_order(star, hot_star, monkeypatch):  # noqa: F811
    dealt = [p for p, _ in exchanges(builders.build_seller_book(star.lines)) if "seller_sk" in p]
    assert not dealt
    # An order with half of the lines is spread by pair, combined on the map side.
    monkeypatch.setattr(keys, "HOT_ROWS", 1_000)
    lines = hot_star.lines.withColumn("seller_sk", F.col("order_item_id") % 700)
    book = builders.build_seller_book(lines)
    pairs = [n for p, n in exchanges(book) if "seller_sk" in p]
    assert pairs and sum(pairs) >= 300
    plain = lines.groupBy("seller_sk", "order_sk").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("price_cents").alias("price_cents")
    )
    got = book.select("seller_sk", "order_sk", "line_count", "price_cents")
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_numbered_rows_do_not_carry_their_slice(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"))
    numbered = assign_surrogate_keys(rows, ["k"], "sk", carry_slice=False)
    numbered.collect()
    carried = assign_surrogate_keys(rows, ["k"], "sk")
    assert sorted(numbered.collect()) == sorted(carried.collect())
    stack, wide = [numbered._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
        else:
            if node.nodeName() == "Exchange":
                wide.append(node.output().mkString(","))
            stack.extend(node.children().apply(i) for i in range(node.children().size()))
    assert any("k#" in names for names in wide)
    assert not any("_slice" in names for names in wide if "k#" in names)
    assert numbered.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first() == (1, 1000, 1000)
