"""Dimension maintenance: insert-if-new and slowly changing versions (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.functions.dates import date_key, date_parts
from oreline.operators.keys import dense_keys
from oreline.session import materialize

CLOSE_MODES = ("second", "half_open")
SAME_DATE_MODES = ("replace", "close")


def date_dimension(df: DataFrame, column: str, naming: str = "en") -> DataFrame:
    """One row per calendar day that occurs in ``column``."""
    days = df.select(F.to_date(column).alias("date")).where(F.col("date").isNotNull()).distinct()
    day = F.col("date")
    parts = [part.alias(name) for name, part in date_parts(day, naming).items()]
    return days.select(date_key(day).alias("sk_date"), "date", *parts)


def missing_from(staged: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Staged rows whose key the dimension does not hold yet."""
    return staged.join(existing.select(*key), list(key), "left_anti")


def insert_if_new(
    existing: DataFrame,
    staged: DataFrame,
    key: Sequence[str],
    surrogate: str | None = None,
    last_key: int = 0,
) -> DataFrame:
    """The rows to append.  Without ``surrogate`` the natural key is the key."""
    fresh = missing_from(staged.distinct(), existing, key)
    if surrogate is None:
        return fresh
    return dense_keys(fresh, surrogate, list(key), last_key)


@dataclass(frozen=True)
class Scd2:
    """Column names and interval rules of a versioned dimension.

    ``close="second"`` ends a version one second before its successor starts;
    ``"half_open"`` ends it at that instant.  ``same_date="replace"`` lets a second
    load with the same start take the place of the first one's version, key
    included; ``"close"`` closes it like any other.
    """

    keys: tuple[str, ...]
    attributes: tuple[str, ...]
    surrogate: str = "sk_customer"
    hash: str = "row_hash"
    start: str = "valid_from"
    end: str = "valid_to"
    active: str = "is_active"
    close: str = "second"
    same_date: str = "replace"

    def __post_init__(self) -> None:
        if self.close not in CLOSE_MODES:
            raise ValueError(f"close must be one of {CLOSE_MODES}")
        if self.same_date not in SAME_DATE_MODES:
            raise ValueError(f"same_date must be one of {SAME_DATE_MODES}")

    @property
    def staged_columns(self) -> list[str]:
        return [*self.keys, *self.attributes, self.hash, self.start]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, *self.staged_columns, self.end, self.active]

    def end_before(self, successor: Column) -> Column:
        if self.close == "half_open":
            return successor
        return successor - F.expr("interval 1 second")

    def exclusive_end(self) -> Column:
        """The first instant after a version, whichever way it was closed."""
        if self.close == "half_open":
            return F.col(self.end)
        return F.col(self.end) + F.expr("interval 1 second")


def scd2_changes(active: DataFrame, staged: DataFrame, spec: Scd2) -> DataFrame:
    """Staged rows that are new or differ from their active version.

    Reads only keys, hash and start of the dimension.  ``_replaces`` carries the
    surrogate key of a version that began on the same date and is to be replaced.
    """
    current = active.select(
        *spec.keys,
        F.col(spec.surrogate).alias("_old_key"),
        F.col(spec.hash).alias("_old_hash"),
        F.col(spec.start).alias("_old_start"),
    )
    replaces = F.lit(None).cast("bigint")
    if spec.same_date == "replace":
        replaces = F.when(F.col("_old_start") >= F.col(spec.start), F.col("_old_key"))
    return (
        staged.select(*spec.staged_columns)
        .join(current, list(spec.keys), "left")
        .where(F.col("_old_hash").isNull() | (F.col("_old_hash") != F.col(spec.hash)))
        .select(*spec.staged_columns, replaces.alias("_replaces"))
    )


def scd2_sweep(active: DataFrame, changes: DataFrame, spec: Scd2) -> DataFrame:
    """The active versions after the changes: kept, closed, or dropped if replaced."""
    marks = changes.select(
        *spec.keys, F.col(spec.start).alias("_new_start"), F.col("_replaces")
    )
    superseded = F.col("_new_start").isNotNull()
    kept = {
        spec.end: F.when(superseded, spec.end_before(F.col("_new_start"))).otherwise(
            F.col(spec.end)
        ),
        spec.active: ~superseded,
    }
    return (
        active.join(marks, list(spec.keys), "left")
        .where(F.col("_replaces").isNull())
        .select(*[kept.get(c, F.col(c)).alias(c) for c in spec.columns])
    )


def scd2_inserts(changes: DataFrame, spec: Scd2, last_key: int) -> DataFrame:
    """New active versions; replaced ones keep the key they had."""
    fresh = dense_keys(
        changes.where(F.col("_replaces").isNull()).drop("_replaces"),
        spec.surrogate,
        list(spec.keys),
        last_key,
    )
    again = changes.where(F.col("_replaces").isNotNull()).withColumnRenamed(
        "_replaces", spec.surrogate
    )
    return fresh.unionByName(again).select(
        spec.surrogate,
        *spec.staged_columns,
        F.lit(None).cast(changes.schema[spec.start].dataType).alias(spec.end),
        F.lit(True).alias(spec.active),
    )


def scd2_merge(
    active: DataFrame, staged: DataFrame, spec: Scd2, last_key: int = 0
) -> DataFrame:
    """Every version the merge leaves behind, except those closed earlier.

    Closed history takes no part: callers append what this closes to it.
    """
    changes = materialize(scd2_changes(active, staged, spec), "scd2-changes")
    return scd2_sweep(active, changes, spec).unionByName(
        scd2_inserts(changes, spec, last_key)
    )


def scd2_history(staged: DataFrame, spec: Scd2) -> DataFrame:
    """All versions from all staged dates at once: the rebuild of a dimension.

    ``staged`` holds one row per key and date.  A row opens a version when its hash
    differs from the key's previous staged row; a date without the key changes
    nothing.
    """
    by_key = Window.partitionBy(*spec.keys).orderBy(spec.start)
    previous = F.lag(spec.hash).over(by_key)
    opened = (
        staged.select(*spec.staged_columns, previous.alias("_previous"))
        .where(F.col("_previous").isNull() | (F.col("_previous") != F.col(spec.hash)))
        .drop("_previous")
    )
    successor = F.lead(spec.start).over(by_key)
    versions = opened.select(
        *spec.staged_columns,
        spec.end_before(successor).alias(spec.end),
        successor.isNull().alias(spec.active),
    )
    keyed = dense_keys(versions, spec.surrogate, [spec.start, *spec.keys])
    return keyed.select(*spec.columns)
