"""Exact two-digit arithmetic for money, percentages and averages.

Money travels through aggregations as BIGINT cents: summing a long stays inside
whole-stage codegen with no per-row decimal objects, and ANSI mode turns an overflow
into an error instead of a wrong figure.  Ratios are rounded once, half away from
zero, on integers, so no result depends on a binary fraction or on the scale a
decimal division happens to keep.  The wide decimals below only ever see aggregated
rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESULT_TYPE = "decimal(20,2)"
_WIDE = "decimal(20,0)"


def cents(amount: Column) -> Column:
    """DECIMAL(p,2) money as BIGINT cents."""
    return (amount * F.lit(100)).cast("bigint")


def from_cents(amount: Column) -> Column:
    """BIGINT cents as DECIMAL(20,2) money."""
    return (amount.cast(_WIDE) * F.lit("0.01").cast("decimal(3,2)")).cast(RESULT_TYPE)


def _hundredths(numerator: Column, denominator: Column, factor: int) -> Column:
    """round(factor * numerator / denominator) half away from zero, read as hundredths.

    NULL when either input is NULL or the denominator is zero.
    """
    n = numerator.cast(_WIDE)
    m = F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))
    doubled = F.abs(n) * F.lit(2 * factor) + F.abs(m)
    magnitude = F.call_function("div", doubled, F.abs(m) * F.lit(2))
    sign = F.when((n < 0) != (m < 0), F.lit(-1)).otherwise(F.lit(1))
    return from_cents(magnitude * sign)


def percent_2dp(part: Column, whole: Column) -> Column:
    """100 * part / whole with two digits."""
    return _hundredths(part, whole, 10_000)


def mean_2dp(total: Column, n: Column) -> Column:
    """Average of an integer quantity with two digits."""
    return _hundredths(total, n, 100)


def mean_cents(total_cents: Column, n: Column) -> Column:
    """Average of a money quantity, given its sum in cents, with two digits."""
    return _hundredths(total_cents, n, 1)


def share_where(condition: Column) -> Column:
    """Percentage of a group's rows satisfying `condition`; NULL counts as not satisfied."""
    return percent_2dp(F.count_if(condition), F.count(F.lit(1)))
