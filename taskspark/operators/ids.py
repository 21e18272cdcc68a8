"""Surrogate ids 1..n in sort order without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taskspark.session import TIGHT, store_and_reload

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in 33 bits below
HOT_COPIES = 65_536


def dense_ids(
    df: DataFrame, sort: Sequence[str], distinct: bool, name: str = "Id", staged: bool = False
) -> DataFrame:
    """Number the rows 1..n by ``sort``, then by all other columns, nulls last.

    The order is total, so the numbers do not depend on partitioning. Range partitions give each
    task a stretch of the order; the stretch sizes, one row per partition, give its first number.
    The stretches are stored before they are counted, so both steps see the same ones. ``staged``
    stores the folded rows before the sort as well: the shuffles that made them are then gone
    when those of the sort come, and the sampling for the ranges reads files.
    """
    columns = df.columns
    order = [*sort, *[c for c in columns if c not in sort]]
    if distinct:
        rows = df.distinct()
        rows = store_and_reload(rows, "distinct", compression=TIGHT) if staged else rows
    else:
        rows = _spread_copies(df, columns, staged)
    if not distinct:
        order.append("__copy")
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = (
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(F.monotonically_increasing_id().alias("__at"), *columns)
    )
    placed = store_and_reload(placed, "ids", compression=TIGHT if staged else None)
    stretch = F.shiftright("__at", ROW_BITS)
    sizes = placed.groupBy(stretch.alias("__stretch")).agg(F.count("*").alias("__size"))
    # One row per partition of the sort: the window over all of them is small.
    before = F.sum("__size").over(
        Window.orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("__stretch", F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = placed.withColumn("__stretch", stretch).join(F.broadcast(offsets), "__stretch")
    at = F.col("__at").bitwiseAND((1 << ROW_BITS) - 1)
    return numbered.select((F.col("__before") + at + 1).alias(name), *columns)


def _spread_copies(df: DataFrame, columns: Sequence[str], staged: bool = False) -> DataFrame:
    """All rows again, equal ones told apart by ``__copy`` so that a range sort can split them.

    Equal rows are counted before they move. Few copies are written out in place; many are cut
    into chunks that are dealt out over the tasks first.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias("__n"))
    counted = store_and_reload(counted, "counted", compression=TIGHT) if staged else counted
    few = counted.where(F.col("__n") <= HOT_COPIES).select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)).alias("__copy")
    )
    chunk = F.sequence(
        F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(HOT_COPIES).cast("bigint")
    )
    many = (
        counted.where(F.col("__n") > HOT_COPIES)
        .select(*columns, "__n", F.explode(chunk).alias("__from"))
        .repartition(*columns, "__from")
        .select(
            *columns,
            F.explode(
                F.sequence(
                    F.col("__from"), F.least(F.col("__from") + HOT_COPIES, F.col("__n")) - 1
                )
            ).alias("__copy"),
        )
    )
    return few.unionByName(many)
