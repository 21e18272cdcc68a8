"""Joins on business keys: new rows, key to id, id to key, rows without a partner.

No join forces a broadcast: Spark broadcasts a side whose size it has measured below its threshold,
and otherwise shuffles both, where adaptive execution splits a hot key of the left side. Every join
here keeps the fact on the left of an inner, left or anti join, the kinds that can be split so, and
shuffles both sides for the join itself, without which it would not be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(source: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is not loaded yet; null equals null. Source duplicates stay.

    Keys are compared as text. Loaded keys are folded to one row each before they move.
    """
    names = {k: f"__known_{k}" for k in keys}
    known = loaded.select(*[F.col(k).cast("string").alias(n) for k, n in names.items()]).distinct()
    same = reduce(
        lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(F.col(n)) for k, n in names.items()]
    )
    return source.join(known, same, "left_anti")


@dataclass(frozen=True)
class Lookup:
    """One foreign key: match ``on`` (source column -> dimension column), take ``id`` as ``name``.

    ``required`` rows without a match are rejects; the others keep a null id. ``name`` may be the
    name of a matched column, which it then replaces. With ``several`` a key may have several ids in
    the dimension, of which the least is taken, so that no source row is doubled.
    """

    entity: str
    on: dict[str, str]
    name: str
    id: str = "Id"
    required: bool = True
    several: bool = False


def choices(look: Lookup, dim: DataFrame) -> DataFrame:
    """Dimension rows whose key has several ids, with the id that ``resolve`` takes as ``chosen``."""
    keys = list(look.on.values())
    text = {k: F.col(k).cast("string").alias(f"__{k}") for k in keys}
    least = dim.groupBy(*text.values()).agg(F.min(look.id).alias("chosen"), F.count("*").alias("__n"))
    several = least.where(F.col("__n") > 1).drop("__n")
    same = reduce(lambda a, b: a & b, [F.col(k).cast("string") == F.col(f"__{k}") for k in keys])
    return dim.join(several, same).drop(*[f"__{k}" for k in keys])


def resolve(source: DataFrame, lookups: Sequence[tuple[Lookup, DataFrame]]) -> DataFrame:
    """Replace keys by ids. ``reject_reason`` names the first required key without a match.

    Every source row stays: ``resolved`` and ``unresolved`` split the result. A dimension row that
    no source row uses adds nothing.
    """
    columns = source.columns
    ids, reasons, used = [], [], set()
    df = source
    for n, (look, dim) in enumerate(lookups):
        renamed = dim.select(
            F.col(look.id).alias(f"__id{n}"),
            *[F.col(d).cast("string").alias(f"__k{n}_{s}") for s, d in look.on.items()],
        )
        if look.several:
            keys = [f"__k{n}_{s}" for s in look.on]
            renamed = renamed.groupBy(*keys).agg(F.min(f"__id{n}").alias(f"__id{n}"))
        match = reduce(
            lambda a, b: a & b,
            [F.col(s).cast("string") == F.col(f"__k{n}_{s}") for s in look.on],
        )
        df = df.join(renamed, match, "left").drop(*[f"__k{n}_{s}" for s in look.on])
        ids.append(F.col(f"__id{n}").alias(look.name))
        if look.required:
            reasons.append(F.when(F.col(f"__id{n}").isNull(), f"no {look.entity}"))
        used.update(look.on)
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    kept = [c for c in columns if c not in used]
    named = [F.col(c).alias(f"key_{c}") for c in columns if c in used]
    return df.select(*kept, *ids, *named, reason.alias("reject_reason"))


def resolved(df: DataFrame) -> DataFrame:
    """Rows of ``resolve`` with all required ids, without the keys they replace."""
    keys = [c for c in df.columns if c.startswith("key_")]
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason", *keys)


def unresolved(df: DataFrame) -> DataFrame:
    """Rows of ``resolve`` that miss a required id, with their keys and the reason."""
    return df.where(F.col("reject_reason").isNotNull())


def expand(df: DataFrame, dim: DataFrame, on: str, id: str = "Id") -> DataFrame:
    """Replace the id column ``on`` by the columns of its dimension; unknown ids give nulls."""
    fact = df.withColumnRenamed(on, "__fk")
    renamed = dim.withColumnRenamed(id, "__id")
    return fact.join(renamed, F.col("__fk") == F.col("__id"), "left").drop("__id", "__fk")


def without_partner(
    left: DataFrame, right: DataFrame, keys: Sequence[str], names: tuple[str, str] = ("left", "right")
) -> DataFrame:
    """Rows of either side whose key the other side lacks, with a ``side`` mark.

    Two anti joins instead of a full outer join, because adaptive execution can split their hot
    keys. Columns a side does not have are null.
    """
    only_left = new_rows(left, right, keys).withColumn("side", F.lit(names[0]))
    only_right = new_rows(right, left, keys).withColumn("side", F.lit(names[1]))
    return only_left.unionByName(only_right, allowMissingColumns=True)
