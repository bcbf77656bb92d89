"""Sinks: partitioned Parquet, rejects, reports, and the landing copy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from oreline.operators.clean import as_text, partition_literals
from oreline.operators.transforms import handler
from oreline.sources.readers import spark_encoding


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Overwrite replaces only the partitions that ``df`` holds rows for."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_rejects(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year", "month", "day")
) -> None:
    """All columns as text, so that no value can clash with a column type."""
    write_partitioned(as_text(df), path, partition_by)


def write_report(df: DataFrame, path: str, files: int | None = None) -> None:
    """A headered CSV report.  ``files`` bounds the file count; leave it out for
    anything large, as one file means one task."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option(
        "header", True
    ).csv(path)


@handler("csv_report")
def csv_report(df, config, ctx):
    """Also write the process output as CSV under ``custom_output.path``."""
    output = config.get("custom_output", {})
    if output.get("path"):
        write_report(
            df, f"{output['path'].rstrip('/')}/{config['process_type']}", output.get("files")
        )
    return df


def land_raw(
    raw: DataFrame,
    path: str,
    execution_date: date,
    delimiter: str = ",",
    encoding: str = "utf-8",
) -> None:
    """Land text rows, values unchanged, in the execution date's partition."""
    (
        partition_literals(raw, execution_date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("sep", delimiter)
        .option("encoding", spark_encoding(encoding))
        .partitionBy("year", "month", "day")
        .csv(path)
    )
