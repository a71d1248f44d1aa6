"""Grouping by keys that hardly ever repeat, without holding all keys of a split."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells that keys are counted in, and the rows from which on a cell can hold a hot key.
CELLS = 1 << 16
HOT_ROWS = 1 << 16


def group_single_keys(
    rows: DataFrame,
    key: Iterable[str],
    combine: Callable[[DataFrame], DataFrame],
    deal_by: Iterable[str] | None = None,
) -> DataFrame:
    """`combine(rows)`, a grouping by `key`, for keys that hardly ever repeat.

    Combining such keys on the map side saves nothing, but holds all keys of a split, which
    spills.  They cross the exchange as they are, into as many partitions as the session plans
    for: merged by their bytes, a tenth of what they take in a hash table, they would spill
    behind it.  Only keys of cells far above the mean are combined first, a hot one among them.

    `deal_by` names columns of the key that rows are dealt out and counted by instead.  Where
    rows that agree in these lie next to each other they stay so, and compress far better.
    """
    key, columns = list(key), rows.columns
    dealt = key if deal_by is None else list(deal_by)
    placed = rows.withColumn("_cell", F.pmod(F.xxhash64(*dealt), F.lit(CELLS)).cast("int"))
    sizes = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"))
    usual = sizes.agg(F.sum("_rows") / CELLS).scalar()
    full = (F.col("_rows") > HOT_ROWS) & (F.col("_rows") > 8 * usual)
    # At most 65,536 cells.
    hot = F.broadcast(sizes.where(full).select("_cell"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = placed.join(hot, "_cell", "left_anti").select(*columns).repartition(partitions, *dealt)
    crowded = placed.join(hot, "_cell", "left_semi").select(*columns)
    return combine(others).unionByName(combine(crowded))
