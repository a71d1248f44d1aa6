from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.functions import (
    blank_to_null,
    cents,
    from_cents,
    mean_2dp,
    mean_cents,
    percent_2dp,
    title_words,
    truth_value,
)


def exact(n: int, m: int, factor: int) -> Decimal:
    value = Decimal(n * factor) / Decimal(m)
    return value.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_percent_and_means_match_exact_decimal_rounding(spark, rows):
    pairs = [(1, 3), (2, 3), (1, 8), (-1, 8), (5, 1000), (-5, 1000), (7, 7), (0, 9)]
    pairs += [(n, m) for n in range(-40, 41, 7) for m in (1, 6, 7, 64, 640)]
    got = (
        rows("n bigint, m bigint", pairs)
        .select("n", "m", percent_2dp(F.col("n"), F.col("m")), mean_2dp(F.col("n"), F.col("m")))
        .collect()
    )
    for n, m, pct, mean in got:
        assert pct == exact(n, m, 100)
        assert mean == exact(n, m, 1)


@settings(max_examples=15, deadline=None)
@given(st.integers(-(10**17), 10**17), st.integers(1, 10**13))
def test_mean_of_cents_is_exact_for_large_sums(n, m):
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    df = spark.createDataFrame([(n, m)], "n bigint, m bigint")
    got = df.select(mean_cents(F.col("n"), F.col("m"))).first()[0]
    assert got == (Decimal(n) / Decimal(m)).quantize(Decimal(1), rounding=ROUND_HALF_UP) / 100


def test_percent_of_large_money_does_not_overflow(rows):
    big = 9 * 10**18 // 4
    df = rows("n bigint, m bigint", [(big, big - 1)])
    assert df.select(percent_2dp(F.col("n"), F.col("m"))).first()[0] == Decimal("100.00")


@pytest.mark.parametrize("n,m", [(5, 0), (None, 3), (3, None)])
def test_missing_or_zero_divisor_gives_null(rows, n, m):
    df = rows("n bigint, m bigint", [(n, m)])
    assert df.select(percent_2dp(F.col("n"), F.col("m"))).first()[0] is None


def test_cents_round_trip(rows):
    df = rows("p string", [("12.34",), ("-0.05",), ("9999999999.99",)])
    price = F.col("p").cast("decimal(12,2)")
    for money, back in df.select(price, from_cents(cents(price))).collect():
        assert money == back


def test_title_words_start_after_any_non_alphanumeric(rows):
    df = rows("c string", [("SANTA BARBARA D'OESTE-x são",), (None,), ("",)])
    assert [r[0] for r in df.select(title_words(F.col("c"))).collect()] == [
        "Santa Barbara D'Oeste-X São",
        None,
        "",
    ]


def test_truth_value_is_three_valued(rows):
    words = ["TRUE", " Yes ", "t", "1", "False", "F", "no", "0", "maybe", "", None]
    got = [r[0] for r in rows("c string", [(w,) for w in words]).select(truth_value(F.col("c"))).collect()]
    assert got == [True] * 4 + [False] * 4 + [None] * 3


def test_blank_keeps_tabs(rows):
    got = rows("c string", [("  ",), ("\t",), (" a ",)]).select(blank_to_null(F.col("c"))).collect()
    assert [r[0] for r in got] == [None, "\t", "a"]
