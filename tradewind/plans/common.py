"""Aggregations shared by the metric plans.

In the order book every row stands for `line_count` lines, so line-weighted averages are
ratios of weighted sums and order counts are plain counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import from_cents, mean_2dp, percent_2dp

# The statuses left out of sales figures.
LOST_STATUSES = ("canceled", "unavailable")


def n_rows() -> Column:
    return F.count(F.lit(1))


def mean_where(value: str, condition: Column | None = None) -> Column:
    """Two-digit average of an integer column over rows where it is filled."""
    v = F.col(value) if condition is None else F.when(condition, F.col(value))
    return mean_2dp(F.sum(v.cast("bigint")), F.count(v))


def weighted_mean(value: str, weight: str = "line_count") -> Column:
    """Two-digit average of `value`, each row counting `weight` times; NULL is left out."""
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    return mean_2dp(F.sum(F.col(value) * w), F.sum(w))


def late_share(weight: str | None = None) -> Column:
    """Late rows as a percentage of all rows; unknown lateness counts as on time."""
    if weight is None:
        return percent_2dp(F.count_if("is_late_delivery"), n_rows())
    late = F.sum(F.when(F.col("is_late_delivery"), F.col(weight)).otherwise(0))
    return percent_2dp(late, F.sum(weight))


def sold(orders: DataFrame, excluded: tuple[str, ...] = LOST_STATUSES) -> DataFrame:
    """Orders (or lines) that count as sales."""
    return orders.where(~F.col("order_status").isin(*excluded)) if excluded else orders


def growth(current: str, order: list[str]) -> Column:
    """Change against the previous row in percent.  For month- and year-grain rows only:
    the un-partitioned window is one small task."""
    previous = F.lag(current).over(Window.orderBy(*order))
    return percent_2dp(F.col(current) - previous, previous)


def money(**columns: str) -> list[Column]:
    """Cent columns as money under the names of the keywords."""
    return [from_cents(F.col(c)).alias(name) for name, c in columns.items()]
