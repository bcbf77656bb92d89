"""Equi-joins of a large frame to a lookup side of unknown size.

The lookup side is broadcast only after it was measured.  Beyond the limit the
join shuffles, and a hot key of the large side is spread over as many slices as
its share of the rows calls for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.literals import quoted
from oreline.session import materialize, shuffle_partitions

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the frame's values, from one aggregation over it."""
    fixed, text = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            text.append(F.coalesce(F.sum(F.octet_length(quoted(f.name))), F.lit(0)))
            fixed += 16
        else:
            fixed += 16 if isinstance(f.dataType, T.DecimalType) else 8
    row = df.agg(
        F.count("*").alias("n"),
        reduce(Column.__add__, text, F.lit(0)).alias("text_bytes"),
    ).first()
    return row["n"] * fixed + row["text_bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


PLANNED, ADAPTIVE = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def least_estimate(df: DataFrame) -> int:
    """The least size that Spark may take columns of a frame for: the bytes of its files, shared out by the columns' types."""
    whole = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # Spark counts 8 bytes for a row besides its columns.
    return whole * 8 // (8 + df._jdf.schema().defaultSize())


def plan_by_rows(spark: SparkSession, frames: Iterable[DataFrame], limit: int = BROADCAST_BYTES) -> None:
    """Keep queries of a session from broadcasting those of the frames that are small only as files.

    Spark plans by the bytes of a frame's files, where a column of few values takes some bits a row.  A broadcast holds
    every row at its whole width, in the driver first.  If a frame's measured values are beyond ``limit``, no broadcast
    is planned from its size in files on; adaptive execution still makes those that its own measurements allow.
    """
    planned = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    sizes = [(least_estimate(f), f) for f in frames]
    wrong = [size for size, f in sizes if size <= planned and not fits_broadcast(f, limit)]
    if wrong:
        if spark.conf.get(ADAPTIVE, None) is None:
            spark.conf.set(ADAPTIVE, str(planned))
        spark.conf.set(PLANNED, str(min(wrong) - 1))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys holding more than two fair shares of the rows, and their slices.

    With P shuffle partitions a fair share is rows / P, so there are fewer than
    P / 2 such keys and fewer than 1.5 P slices, whatever the data.
    """
    partitions = shuffle_partitions(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    share = F.col("n") * F.lit(partitions)
    return (
        counts.where(share > F.lit(2) * total.scalar())
        .select(*keys, F.ceil(share / total.scalar()).cast("int").alias("_slices"))
    )


def skew_safe_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: str,
    how: str = "inner",
    condition: Column | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Shuffled equi-join that gives no task more than a few fair shares.

    ``spread`` is a column of ``large`` whose values are unique, so that even
    identical copies of a row land in different slices.  Lookup rows of a hot key
    are repeated once per slice; all other rows are joined as they are.  Rows with
    a NULL key match nothing and are spread out too.  ``key_source`` names a frame
    whose keys are those of ``large`` but cheaper to count, such as a plain scan.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    # Counted once: both sides of the join need the answer.
    counted = materialize(hot_keys(key_source or large, keys), "hot-keys")
    hot = F.broadcast(counted)  # fewer than P / 2 rows
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    slices = F.when(null_key, shuffle_partitions(large.sparkSession)).otherwise(
        F.coalesce(F.col("_slices"), F.lit(1))
    )
    sliced = large.join(hot, list(keys), "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread), slices).cast("int")
    )
    copies = lookup.join(hot, list(keys), "left").select(
        *lookup.columns,
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)).alias(
            "_slice"
        ),
    )
    on = [sliced[k] == copies[k] for k in keys] + [sliced["_slice"] == copies["_slice"]]
    if condition is not None:
        on.append(condition)
    joined = sliced.join(copies, reduce(Column.__and__, on), how)
    return joined.select(
        *[sliced[c] for c in large.columns],
        *[copies[c] for c in lookup.columns if c not in keys],
    )


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: str,
    how: str = "inner",
    condition: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Join by broadcast where the measured lookup side allows, else by slices."""
    if not fits_broadcast(lookup, broadcast_bytes):
        return skew_safe_join(large, lookup, keys, spread, how, condition, key_source)
    on = [large[k] == lookup[k] for k in keys]
    if condition is not None:
        on.append(condition)
    joined = large.join(F.broadcast(lookup), reduce(Column.__and__, on), how)
    return joined.select(
        *[large[c] for c in large.columns],
        *[lookup[c] for c in lookup.columns if c not in keys],
    )
