"""Bounded samples that are picked by a filter alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_hash(key: str, kind: str, totals: Mapping, bounds: Mapping) -> Column:
    """Whether a row is in the sample of about ``bounds[kind]`` rows out of the ``totals[kind]`` there are.

    The hash of ``key`` decides, so nothing is ranked or moved, and the same keys are picked every time. A kind
    with no more rows than its bound is taken whole; the size of the others varies around the bound as a
    binomial does. Rows with a null key or a kind without a total are not in it.
    """
    rates = {k: bounds[k] / n if n > bounds[k] else 2.0 for k, n in totals.items()}
    if not rates:
        return F.lit(False)
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])[F.col(kind)]
    place = F.xxhash64(key) / F.lit(2.0**64) + 0.5
    return F.coalesce(F.col(key).isNotNull() & (place < rate), F.lit(False))
