"""Group values brought back to the rows of the group.

Not windows: a window moves a whole group into one task, and one item or owner may hold a third of
all rows. The group is folded before it moves, and the join back keeps the rows on the left, where
adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspark.session import store_and_reload


def with_group_values(
    df: DataFrame,
    keys: Sequence[str],
    *values: Column,
    measured: bool = False,
    of: DataFrame | None = None,
) -> DataFrame:
    """``df`` with aggregates of its groups added; null keys form a group.

    ``of`` are the rows the groups are folded from, ``df`` itself by default: where ``df`` is the
    outcome of joins that add columns only, the narrow rows before them give the same groups.

    ``measured`` stores the groups first. Where few are expected this saves a shuffle of all rows:
    Spark then knows their size, broadcasts them if they are small, and shuffles if they are not.

    The null-safe match is not what the groups are partitioned by, so their few rows are shuffled
    once more for the join: adaptive execution splits hot keys only between two such shuffles.
    """
    names = {k: f"__group_{k}" for k in keys}
    groups = (df if of is None else of).groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(*values)
    if measured:
        groups = store_and_reload(groups, "groups")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(groups, same, "left").drop(*names.values())
