"""Surrogate keys without a single-task window.

Rows are written once; a row's key is the number of rows in the files before its
own plus its position in the file.  Both come from file metadata, so a lost
executor or a retried task gives the same keys again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import as_nullable, scratch_path

#: Files whose offsets are broadcast: some 20 MB.
BROADCAST_FILES = 100_000

# The task and file numbers in the name Spark gives a file.
_TASK_NUMBER = r"part-(\d+)-[^/]*$"
_FILE_NUMBER = r"-c(\d+)[^/]*$"


def keys_by_position(source: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Number the rows of written Parquet files: start + 1, start + 2, ...

    ``source`` must be a plain read of files that one Spark job wrote.  Files count in
    the order of the tasks that wrote them, so a range-partitioned, sorted write
    numbers in order.
    """
    placed = source.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    per_file = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    # One row per file: file listings are driver-sized by nature.
    in_write_order = Window.orderBy(
        F.regexp_extract("_file", _TASK_NUMBER, 1).cast("bigint"),
        F.regexp_extract("_file", _FILE_NUMBER, 1).cast("bigint"),
        "_file",
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_file.select(
        "_file", (F.sum("_n").over(in_write_order) - F.col("_n")).alias("_before")
    )
    # The number of files is known without a job; beyond the limit Spark chooses the join.
    known = F.broadcast(offsets) if len(source.inputFiles()) <= BROADCAST_FILES else offsets
    return placed.join(known, "_file").select(
        (F.lit(start) + F.col("_before") + F.col("_index") + 1).cast("bigint").alias(key),
        *source.columns,
    )


def dense_keys(
    df: DataFrame, key: str, order_by: Sequence[str], start: int = 0
) -> DataFrame:
    """Number rows start + 1, start + 2, ... in the order of ``order_by``.

    ``order_by`` should be unique, as a natural key is; then the numbers equal a
    global ``row_number`` and no range can grow hot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.parquet(path)
    stored = spark.read.schema(as_nullable(df.schema)).parquet(path)
    return keys_by_position(stored, key, start)


def max_key(df: DataFrame, key: str) -> int:
    return df.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
