"""Fact rows: surrogate-key lookup, orphans, and the overlap check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.operators.dimensions import Scd2
from oreline.operators.joins import BROADCAST_BYTES, lookup_join


def lookup_active(
    facts: DataFrame,
    dimension: DataFrame,
    spec: Scd2,
    spread: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Key of the version that is active now, whatever the fact's time."""
    current = dimension.where(F.col(spec.active)).select(*spec.keys, spec.surrogate)
    return lookup_join(
        facts, current, spec.keys, spread, how, None, broadcast_bytes, key_source
    )


def lookup_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    spec: Scd2,
    event_time: str,
    spread: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    key_source: DataFrame | None = None,
    open_start: bool = False,
) -> DataFrame:
    """Key of the version that was valid at the fact's time.

    The interval test is a residual of the equi-join, so the join stays a hash or
    merge join on the natural key.  With ``open_start`` a key's first version reaches back without limit: it starts
    when it was loaded, and what happened before is as much its own.
    """
    start = F.col(spec.start)
    if open_start:
        first = dimension.groupBy(*spec.keys).agg(F.min(spec.start).alias("_first"))
        dimension = dimension.join(first, list(spec.keys))
        start = F.when(start > F.col("_first"), start)
    versions = dimension.select(
        *spec.keys,
        spec.surrogate,
        start.alias("_from"),
        spec.exclusive_end().alias("_until"),
    )
    moment = facts[event_time]
    since = F.col("_from").isNull() | (moment >= F.col("_from"))
    valid = since & (F.col("_until").isNull() | (moment < F.col("_until")))
    return lookup_join(
        facts, versions, spec.keys, spread, how, valid, broadcast_bytes, key_source
    ).drop("_from", "_until")


def lookup_key(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    spread: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Key of an unversioned dimension."""
    known = dimension.select(*keys, surrogate)
    return lookup_join(facts, known, keys, spread, how, None, broadcast_bytes, key_source)


def resolved(surrogates: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(s).isNotNull() for s in surrogates])


def not_loaded_yet(
    staged: DataFrame,
    loaded: DataFrame,
    key: Sequence[str],
    spread: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Staged rows whose natural key the fact table does not hold.

    For loads that reread an overlap behind the watermark.  Pass ``loaded`` already
    cut to that overlap, so only its partitions are read.  Copies of one key, however
    many, are spread like those of any hot key.
    """
    held = loaded.select(*key).distinct().withColumn("_held", F.lit(True))
    marked = lookup_join(staged, held, key, spread, "left", None, broadcast_bytes)
    return marked.where(F.col("_held").isNull()).drop("_held")
