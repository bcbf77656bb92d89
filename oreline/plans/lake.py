"""Where a lake keeps things, and how committed rows are read back."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.contract import Contract
from oreline.ledger import SUCCESS, DataFile, Ledger, LedgerView
from oreline.operators.quality import REJECTED, VALID
from oreline.session import as_nullable
from oreline.sources.readers import read_if_present

SILVER, GOLD = "silver", "gold"


class NotLoaded(LookupError):
    """The input of a job was never committed."""


@dataclass(frozen=True)
class Lake:
    """Folders of one lake.  Everything below a ``run_id=`` folder belongs to one run.  Tables are read by the files
    that the ledger's SUCCESS events name, so folders of other runs are not even listed."""

    spark: SparkSession
    root: str

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def silver(self, source: str) -> str:
        return f"{self.root}/silver/{source}"

    def gold(self, gold_path: str, execution_date: date, run_id: str) -> str:
        return f"{self.root}/gold/{gold_path}/exec={execution_date:%Y-%m-%d}/run_id={run_id}"

    def table(self, name: str) -> str:
        return f"{self.root}/warehouse/{name}"

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")


def silver_run(lake: Lake, source: str, execution_date: date) -> str:
    run = lake.ledger.last_success(SILVER, source, execution_date)
    if run is None:
        raise NotLoaded(f"no committed Silver run of {source!r} for {execution_date}")
    return run["run_id"]


def read_outcome(lake: Lake, contract: Contract, run_id: str, outcome: str) -> DataFrame:
    """One outcome of one Silver run; a partition folder, so nothing else is listed.

    The folder holds the contract's columns and whatever the source had besides;
    it is missing when no row had the outcome.
    """
    path = f"{lake.silver(contract.source_name)}/run_id={run_id}/outcome={outcome}"
    dated = ", ".join(f"`{k}` string" for k in contract.partition_keys)
    raw = ", ".join(f"`{c.name}`: string" for c in contract.columns)
    fields = T.StructType.fromDDL(f"{dated}, _reasons array<string>, _raw struct<{raw}>").fields
    empty = T.StructType(as_nullable(contract.schema).fields + fields)
    found = read_if_present(lake.spark, path, empty, infer=True).schema
    # Partition values are text, whatever they look like.
    kinds = [T.StringType() if f.name in contract.partition_keys else f.dataType for f in found]
    typed = T.StructType([T.StructField(f.name, k, True) for f, k in zip(found, kinds)])
    return read_if_present(lake.spark, path, typed)


def read_silver(
    lake: Lake, contract: Contract, execution_date: date, run_id: str | None = None
) -> DataFrame:
    """The valid rows of the day's latest committed Silver run, or of a given run."""
    run_id = run_id or silver_run(lake, contract.source_name, execution_date)
    return read_outcome(lake, contract, run_id, VALID).drop("_reasons", "_raw")


def read_rejects(lake: Lake, contract: Contract, run_id: str) -> DataFrame:
    """Rejected rows as the text that arrived, with the rules they failed.

    Takes a run id because a run that failed its gate is not committed, and its
    rejects are just what one wants to see then.
    """
    rejected = read_outcome(lake, contract, run_id, REJECTED)
    return rejected.select("_raw.*", F.col("_reasons").alias("reasons"))


#: Roles of a table's files: appended rows, closed versions, and active ones by bucket.
ROWS, CLOSED, ACTIVE = "rows", "closed", "active"


def read_files(lake: Lake, table: str, files: list[DataFile], schema: T.StructType) -> DataFrame:
    """Rows of some files of a table; a file that the ledger names and that is gone is an error."""
    if not files:
        return lake.spark.createDataFrame([], as_nullable(schema))
    root = lake.table(table)
    reader = lake.spark.read.schema(as_nullable(schema)).option("basePath", root)
    return reader.parquet(*[f"{root}/{f.path}" for f in files]).select(*schema.names)


def written_files(
    lake: Lake, table: str, run_id: str, schema: T.StructType, part=lambda path: ROWS, key: str | None = None
) -> list[DataFile]:
    """The files that a run has written to a table, with row counts and the bounds of ``key``.

    Read back from the files, not from the job that wrote them, so retried tasks do not count twice.
    """
    root = f"{lake.table(table)}/run_id={run_id}"
    bound = (F.col(key) if key else F.lit(None)).cast("string")
    found = (
        lake.spark.read.schema(as_nullable(schema))
        .parquet(root)
        .groupBy("_metadata.file_path")
        .agg(F.count("*").alias("rows"), F.min(bound).alias("low"), F.max(bound).alias("high"))
        .collect()
    )
    inside = f"/run_id={run_id}/"
    files = []
    for row in found:
        path = f"run_id={run_id}/" + unquote(row["file_path"]).partition(inside)[2]
        files.append(DataFile(table, part(path), path, row["rows"], row["low"], row["high"]))
    return sorted(files, key=lambda f: f.path)


def read_appended(
    lake: Lake, table: str, schema: T.StructType, view: LedgerView | None = None, above: str | None = None
) -> DataFrame:
    """A table that runs append to: the rows of all committed runs.

    ``above`` leaves out files whose key has no value above it.
    """
    files = (view or lake.ledger.view()).files(table)
    wanted = [f for f in files if f.part == ROWS and (above is None or f.high is None or f.high > above)]
    return read_files(lake, table, wanted, schema)


def active_part(buckets: int, bucket: int) -> str:
    return f"{ACTIVE}:{buckets}:{bucket}"


def read_active(
    lake: Lake, table: str, schema: T.StructType, view: LedgerView | None = None
) -> DataFrame:
    """The active versions of a versioned table."""
    files = (view or lake.ledger.view()).files(table)
    return read_files(lake, table, [f for f in files if f.part.startswith(ACTIVE)], schema)


def read_versions(
    lake: Lake, table: str, schema: T.StructType, view: LedgerView | None = None
) -> DataFrame:
    """All versions: the active ones and every committed closure."""
    return read_files(lake, table, (view or lake.ledger.view()).files(table), schema)


def committed_rows(lake: Lake, path: str, column: str) -> dict[str, int]:
    """Row counts by a partition column of what a run has just written.

    Counting the files, not the job that wrote them, stays exact when tasks were
    retried; row counts come from the Parquet footers.
    """
    schema = T.StructType([T.StructField(column, T.StringType(), True)])
    counts = read_if_present(lake.spark, path, schema).groupBy(column).count()
    return {row[column]: row["count"] for row in counts.collect()}


__all__ = [
    "ACTIVE", "CLOSED", "GOLD", "ROWS", "SILVER", "SUCCESS", "Lake", "NotLoaded", "active_part", "committed_rows",
    "read_active", "read_appended", "read_files", "read_outcome", "read_rejects", "read_silver", "read_versions",
    "silver_run", "written_files",
]
