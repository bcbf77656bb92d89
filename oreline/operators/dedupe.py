"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep the greatest row of each key.

    Rows compare by ``order_by`` and then by all remaining columns, so ties are
    settled by value.  The maximum is combined before the shuffle: however many
    copies a key has, each task sends one row for it.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = list(order_by) + [c for c in rest if c not in order_by]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns]
    )
