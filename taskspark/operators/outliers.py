"""Isolation forest (Liu, Ting, Zhou 2008): rows that few random cuts isolate are outliers.

The trees only ever see a bounded sample, so they are grown from one broadcast; scoring is a map
over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark import vocab

TREES = 100
ROWS_PER_TREE = 256
POOL_ROWS = TREES * ROWS_PER_TREE
HASH_RANGE = 1 << 30


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of nodes. ``depth`` of a leaf includes the mean depth its rows would add."""

    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    depth: np.ndarray
    rows_per_tree: int

    @property
    def nodes(self) -> tuple[np.ndarray, ...]:
        return self.feature, self.cut, self.low, self.depth


def sample_pool(df: DataFrame, columns: Sequence[str], key: str, seed: int) -> np.ndarray:
    """At most ``POOL_ROWS`` rows, chosen by a hash of their key and so the same on every run.

    A threshold on the hash leaves about four times as many without a shuffle; of those, the rows
    with the lowest hashes are the pool.
    """
    rows = df.count()
    share = min(1.0, 4 * POOL_ROWS / max(rows, 1))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(HASH_RANGE))
    values = [F.col(c).cast("double").alias(c) for c in columns]
    drawn = df.select(draw.alias("__draw"), *values).where(F.col("__draw") < math.ceil(share * HASH_RANGE))
    pool = drawn.orderBy("__draw", *columns).limit(POOL_ROWS).select(*columns)
    return pool.toPandas().to_numpy(dtype=float)


def grow_forest(
    df: DataFrame, columns: Sequence[str], key: str = "Id", seed: int = vocab.SEED
) -> Forest:
    """One tree per random subset of the pool, grown as Spark tasks."""
    pool = sample_pool(df, columns, key, seed)
    size = min(ROWS_PER_TREE, len(pool))
    shared = df.sparkSession.sparkContext.broadcast(pool)

    def grow(batches):
        for batch in batches:
            for tree in batch["id"]:
                rng = np.random.default_rng([seed, int(tree)])
                rows = shared.value[rng.permutation(len(shared.value))[:size]]
                nodes = _grow_tree(rows, rng, math.ceil(math.log2(max(size, 2))))
                yield pd.DataFrame(nodes, columns=["feature", "cut", "low", "depth"]).assign(tree=tree)

    spark = df.sparkSession
    grown = spark.range(0, TREES, 1, min(TREES, spark.sparkContext.defaultParallelism)).mapInPandas(
        grow, "feature int, cut double, low int, depth double, tree long"
    )
    nodes = grown.toPandas()
    width = int(nodes.groupby("tree").size().max())

    def table(name, dtype):
        out = np.zeros((TREES, width), dtype=dtype)
        for tree, part in nodes.groupby("tree"):
            out[tree, : len(part)] = part[name]
        return out

    return Forest(
        table("feature", np.int32), table("cut", float), table("low", np.int32), table("depth", float), size
    )


def mean_depth(n):
    """Mean depth of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def _grow_tree(rows, rng, height):
    """Nodes ``(feature, cut, first child, depth)``; a leaf has feature -1. Children are adjacent."""
    nodes, todo = [None], [(0, rows, 0)]
    while todo:
        at, part, level = todo.pop()
        spans = part.max(axis=0) - part.min(axis=0)
        usable = np.flatnonzero(spans > 0)
        if level >= height or len(part) <= 1 or not len(usable):
            nodes[at] = (-1, 0.0, 0, level + mean_depth(len(part)))
            continue
        feature = int(rng.choice(usable))
        values = part[:, feature]
        cut = rng.uniform(values.min(), values.max())
        left = values <= cut
        nodes[at] = (feature, cut, len(nodes), 0.0)
        todo += [(len(nodes), part[left], level + 1), (len(nodes) + 1, part[~left], level + 1)]
        nodes += [None, None]
    return nodes


def path_depths(nodes: tuple[np.ndarray, ...], rows: np.ndarray) -> np.ndarray:
    """Mean leaf depth of each row over the trees of ``Forest.nodes``."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for feature, cut, low, depth in zip(*nodes):
        at = np.zeros(len(rows), dtype=np.int32)
        inner = feature[at] >= 0
        while inner.any():
            here = at[inner]
            right = rows[every[inner], feature[here]] > cut[here]
            at[inner] = low[here] + right
            inner = feature[at] >= 0
        total += depth[at]
    return total / len(nodes[0])


def with_outlier_score(
    df: DataFrame,
    columns: Sequence[str] = vocab.OUTLIER_COLUMNS,
    key: str = "Id",
    seed: int = vocab.SEED,
) -> DataFrame:
    """``outlier_score`` between 0 and 1; about 0.5 for an ordinary row."""
    forest = grow_forest(df, columns, key, seed)
    shared = df.sparkSession.sparkContext.broadcast(forest.nodes)
    usual = max(mean_depth(forest.rows_per_tree), 1e-12)

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        rows = np.column_stack([v.to_numpy(dtype=float) for v in values])
        return pd.Series(np.exp2(-path_depths(shared.value, rows) / usual))

    return df.withColumn("outlier_score", score(*[F.col(c).cast("double") for c in columns]))


def drop_outliers(
    df: DataFrame,
    columns: Sequence[str] = vocab.OUTLIER_COLUMNS,
    key: str = "Id",
    seed: int = vocab.SEED,
    cut: float = 0.5,
) -> DataFrame:
    """Rows that are no outliers. A row that lacks one of the values cannot be scored: it raises."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    whole = F.assert_true(present, F.lit("missing value in an outlier column"))
    scored = with_outlier_score(df.where(whole.isNull()), columns, key, seed)
    # A row of mean depth scores one half up to rounding, and is no outlier.
    return scored.where(F.col("outlier_score") <= cut + 1e-9).drop("outlier_score")
