"""Bronze to Silver: clean, type and judge a source in one pass over it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.contract import Contract
from oreline.ledger import Run
from oreline.operators.clean import (
    RAW,
    contract_cast,
    normalize_values,
    partition_literals,
    rename_bulk,
)
from oreline.operators.quality import (
    INDETERMINATE,
    OUTCOME,
    REASONS,
    REJECTED,
    VALID,
    RowMetrics,
    check_gate,
    flag_rows,
    row_rules,
)
from oreline.plans.lake import SILVER, Lake, committed_rows
from oreline.sources.readers import day_folder, read_source


def judged_rows(
    raw: DataFrame,
    contract: Contract,
    execution_date: date,
    as_of: datetime | None = None,
    null_policy: str = "strict",
) -> DataFrame:
    """Raw text rows with names, spellings, types, outcome and reasons.

    Nothing but projections, so scan, parsing and judging share one stage.
    """
    named = normalize_values(rename_bulk(raw, contract.column_renames), contract.normalizations)
    typed = contract_cast(named, contract, keep_raw=True)
    dated = partition_literals(typed, execution_date)
    rules = row_rules(contract, as_of, null_policy, with_cast_failures=True)
    return flag_rows(dated, rules)


def silver_job(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    execution_date: date,
    as_of: datetime | None = None,
    null_policy: str = "strict",
    allow_empty: bool = False,
    raw: DataFrame | None = None,
    batch_id: int | None = None,
    stream_id: str | None = None,
) -> Run:
    """Load one day of a source.

    The judged rows are written once, partitioned by outcome, and the counts are
    taken from the files.  The gate comes last: when it raises, rejects and counts
    are on record, and the run's valid rows stay unpublished.
    """
    source = contract.source_name
    with lake.ledger.run(SILVER, source, execution_date, batch_id, stream_id) as run:
        if raw is None:
            raw = read_source(spark, contract, day_folder(lake.bronze(source), execution_date))
        judged = judged_rows(raw, contract, execution_date, as_of, null_policy)
        path = f"{lake.silver(source)}/run_id={run.run_id}"
        evidence = F.when(F.col(OUTCOME) != VALID, F.col(RAW))
        (
            judged.withColumn(RAW, evidence)
            .withColumnRenamed(OUTCOME, "outcome")
            .write.partitionBy("outcome", *contract.partition_keys)
            .parquet(path)
        )
        counts = committed_rows(lake, path, "outcome")
        metrics = RowMetrics(
            rows_read=sum(counts.values()),
            rows_valid=counts.get(VALID, 0),
            rows_rejected=counts.get(REJECTED, 0),
            rows_indeterminate=counts.get(INDETERMINATE, 0),
        )
        run.rows_read = metrics.rows_read
        run.rows_valid = metrics.rows_valid
        run.rows_rejected = metrics.rows_rejected
        run.rows_indeterminate = metrics.rows_indeterminate
        check_gate(metrics, contract, allow_empty)
    return run


__all__ = ["REASONS", "judged_rows", "silver_job"]
