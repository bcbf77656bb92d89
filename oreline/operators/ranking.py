"""Rank and top-k over a whole table without a whole-table task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import materialize


def top_k_by_rank(df: DataFrame, score: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows with ``rank() over (order by score desc nulls last) <= k``.

    Ties share a rank, so the result may hold any number of rows.  The k-th best
    score is found by a distributed top-k; rows below it leave.  At most k distinct
    scores remain, and only those, with their row counts, are ranked in one task.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    stored = materialize(df, "scored")
    # One value; NULL when fewer than k rows have a score, as then all rank within k.
    floor = (
        stored.select(score)
        .orderBy(F.desc_nulls_last(score))
        .limit(k)
        .agg(F.when(F.count(score) >= k, F.min(score)))
        .first()[0]
    )
    contenders = stored if floor is None else stored.where(F.col(score) >= F.lit(floor))
    best_first = Window.orderBy(F.desc_nulls_last("_score")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = (
        contenders.groupBy(F.col(score).alias("_score"))
        .agg(F.count("*").alias("_n"))
        .select(
            "_score",
            (F.coalesce(F.sum("_n").over(best_first), F.lit(0)) + 1).cast("bigint").alias(rank),
        )
    )
    return contenders.join(
        F.broadcast(ranks), F.col(score).eqNullSafe(F.col("_score"))
    ).select(rank, *df.columns)


def latest(df: DataFrame, order_by: str, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` most recent rows."""
    return df.orderBy(F.desc(order_by), *tie_break).limit(n)
