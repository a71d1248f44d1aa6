"""Dense numbering and ntile over whole tables, without a single-task global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.session import scratch_path
from tradewind.sources.tables import materialize_table

# Numbers depend on this constant, so it is not a tuning knob.  Four hexadecimal digits give
# 65,536 slices: several for each of some thousand shuffle partitions, which evens out how
# slices fall on partitions, while the table of slice starts stays at one or two megabytes.
SLICE_DIGITS = 4


def key_slice(columns: list[str]) -> Column:
    """Slice of a row: the leading digits of a digest of its key, as an INT.

    Keys spread evenly whatever their distribution, and the slice depends on the row
    alone, so a task that is run again after a lost executor numbers identically.  Every row
    carries its slice through an exchange, where a number takes half the room of a text.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, SLICE_DIGITS)
    return F.conv(digits, 16, 10).cast("int")


def assign_surrogate_keys(
    rows: DataFrame,
    key: list[str],
    name: str,
    keys_only: DataFrame | None = None,
    carry_slice: bool = True,
) -> DataFrame:
    """Append a BIGINT 1..N in the order (slice of the key, key); `key` must be unique.

    One light pass counts keys per slice; its running total, at most 65,536 rows, is
    broadcast.  The rows then need one exchange by slice and a sort inside each.
    Without `carry_slice` the rows leave their slice behind at the exchange and work it out
    again: a digest more for each, a tenth or more of what narrow rows take on their way.
    `keys_only` may name a cheaper source of the same keys for the counting pass.
    Restarting at 1 on each rebuild and numbering equal inputs equally are inherent.
    """
    slices = (keys_only if keys_only is not None else rows).select(key_slice(key).alias("_slice"))
    sizes = slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    inside = Window.partitionBy("_slice").orderBy(*[F.asc_nulls_first(c) for c in key])
    dealt = rows if carry_slice else rows.repartition(key_slice(key))
    numbered = dealt.withColumn("_slice", key_slice(key)).withColumn(
        "_nth", F.row_number().over(inside)
    )
    return numbered.join(F.broadcast(starts), "_slice").select(
        (F.col("_start") + F.col("_nth")).alias(name), *rows.columns
    )


def stored_positions(rows: DataFrame, label: str) -> DataFrame:
    """`rows` in their present order with `_position` (from 0) and `_total` appended.

    The rows are written to the shared scratch folder with the task number and the row
    number inside the task; positions read back from storage cannot change when an
    executor is lost between the two passes.  No exchange is added.
    """
    marked = rows.withColumn("_at", F.monotonically_increasing_id())
    stored = materialize_table(marked, scratch_path(rows.sparkSession, label))

    # monotonically_increasing_id: task number in the upper bits, row number in the lower 33
    task = F.shiftright("_at", 33)
    sizes = stored.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_size"))
    by_task = Window.orderBy("_task")
    before = by_task.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_task.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per write task, so the broadcast is bounded by the task count.
    starts = sizes.select(
        "_task",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(everything).alias("_total"),
    )
    inside_task = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .select(*rows.columns, (F.col("_start") + inside_task).alias("_position"), "_total")
    )


# Numbers that one row of a group is unfolded into at a time.
_UNFOLDED = 1 << 16


def number_rows(rows: DataFrame, name: str) -> DataFrame:
    """Prepend a dense 1..N to rows that may repeat; lazy.

    Equal rows meet on the map side and cross the exchange as one row with their count, so a
    row that repeats a billion times is no burden; behind the numbering they are unfolded in
    place.  Numbers follow (slice of the row, row), as in `assign_surrogate_keys`, and depend
    on the data alone: equal rows may swap theirs without a difference.
    """
    columns = rows.columns
    of_row = key_slice(columns)
    sizes = rows.select(of_row.alias("_slice")).groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    inside = Window.partitionBy("_slice").orderBy(*[F.asc_nulls_first(c) for c in columns])
    upto = F.sum("_copies").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    placed = groups.withColumn("_slice", of_row).withColumn("_upto", upto)
    # At most 65,536 starts.
    placed = placed.join(F.broadcast(starts), "_slice").select(
        *columns, "_copies", (F.col("_start") + F.col("_upto") - F.col("_copies")).alias("_before")
    )
    return unfold(placed, "_copies", "_nth").select(
        (F.col("_before") + F.col("_nth")).alias(name), *columns
    )


def unfold(rows: DataFrame, times: str, nth: str = "_nth") -> DataFrame:
    """Every row as often as its column `times` says, numbered from 1; no array grows with it."""
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"({times} - 1) div {_UNFOLDED}")))
    last = F.least(F.col(times), (F.col("_block") + 1) * _UNFOLDED)
    numbers = F.explode(F.sequence(F.col("_block") * _UNFOLDED + 1, last))
    return rows.withColumn("_block", blocks).withColumn(nth, numbers).drop("_block")


def global_ntile(rows: DataFrame, order: list[Column], buckets: int, name: str) -> DataFrame:
    """NTILE(buckets) OVER (ORDER BY order) without pulling all rows into one task.

    `order` must end in a unique column: that makes the result reproducible and lets the
    range exchange cut through long runs of equal values.
    """
    placed = stored_positions(rows.orderBy(*order), f"ordered-{name}")
    tile = _tile(F.col("_position"), F.col("_total"), buckets).cast("int")
    return placed.select(*rows.columns, tile.alias(name))


def _tile(position: Column, total: Column, buckets: int) -> Column:
    """Tile of a 0-based position: the first `total % buckets` tiles hold one row more."""
    n = F.lit(buckets).cast("bigint")
    small = _div(total, n)
    larger = total % n
    in_larger = larger * (small + 1)
    return F.when(position < in_larger, _div(position, small + 1) + 1).otherwise(
        larger + _div(position - in_larger, F.greatest(small, F.lit(1))) + 1
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)
