"""Audit of declared constraints: NOT NULL, length, primary key, foreign key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = "constraint_name string, violations bigint"


def null_and_length_audit(
    df: DataFrame,
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
) -> DataFrame:
    """All column checks in one pass, one output row per check."""
    checks = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for c, n in (max_length or {}).items():
        checks[f"max_length:{c}"] = F.count_if(F.length(c) > n)
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("constraint_name"), count.alias("violations"))
                for name, count in checks.items()
            ]
        ).alias("checks")
    )
    return counts.select(F.inline("checks"))


def primary_key_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key."""
    excess = df.groupBy(*key).agg((F.count("*") - 1).alias("n"))
    return excess.agg(
        F.lit(f"primary_key:{','.join(key)}").alias("constraint_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"),
    )


def foreign_key_audit(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; NULL refers to nothing and passes.

    Counting per key first means a hot key reaches the join as one row.
    """
    per_key = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_fk"))
        .agg(F.count("*").alias("n"))
    )
    orphans = per_key.join(
        parent.select(F.col(parent_key).alias("_fk")), "_fk", "left_anti"
    )
    return orphans.agg(
        F.lit(f"foreign_key:{column}").alias("constraint_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"),
    )


def constraint_audit(*audits: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, audits)
