"""File streams that land, judge and load what arrives.

The stream's checkpoint remembers which files were taken, which is what an arrival
check and a copy step would otherwise do.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreline.contract import Contract
from oreline.ledger import utc_now
from oreline.plans.daily import daily_load
from oreline.plans.lake import SILVER, Lake
from oreline.plans.silver import silver_job
from oreline.sources.readers import spark_encoding, text_schema


def stream_source(
    spark: SparkSession,
    contract: Contract,
    incoming: str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The contract's source as an unbounded frame of text columns."""
    reader = spark.readStream.schema(text_schema(contract.raw_headers))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if contract.file_format == "csv":
        return (
            reader.option("header", True)
            .option("sep", contract.delimiter)
            .option("encoding", spark_encoding(contract.encoding))
            .option("enforceSchema", False)
            .csv(incoming)
        )
    return getattr(reader, contract.file_format)(incoming)


def stream_landing(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    incoming: str,
    checkpoint: str,
    day: Column | None = None,
) -> StreamingQuery:
    """Land new files under the day they arrive (or the given ``day`` column).

    The file sink's log makes a repeated batch harmless.
    """
    arrived = day if day is not None else F.current_date()
    dated = stream_source(spark, contract, incoming).withColumns(
        {
            "year": F.date_format(arrived, "yyyy"),
            "month": F.date_format(arrived, "MM"),
            "day": F.date_format(arrived, "dd"),
        }
    )
    return (
        dated.writeStream.format("csv")
        .option("header", True)
        .option("sep", contract.delimiter)
        .option("encoding", spark_encoding(contract.encoding))
        .option("checkpointLocation", checkpoint)
        .partitionBy("year", "month", "day")
        .trigger(availableNow=True)
        .start(lake.bronze(contract.source_name))
    )


def stream_silver(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    incoming: str,
    checkpoint: str,
    as_of: datetime | None = None,
    date_of: Callable[[int], date] | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Run the Silver job on each micro-batch; a batch that was committed is skipped."""

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = stream_identity(spark, checkpoint)
        if lake.ledger.batch_run(SILVER, contract.source_name, batch_id, stream) is None:
            silver_job(
                spark,
                lake,
                contract,
                _day_of(date_of, batch_id),
                as_of=as_of,
                raw=batch,
                batch_id=batch_id,
                stream_id=stream,
            )

    return _start(stream_source(spark, contract, incoming, files_per_batch), checkpoint, load)


def stream_daily(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    dimensions: Sequence[Mapping[str, Any]],
    facts: Sequence[Mapping[str, Any]],
    incoming: str,
    checkpoint: str,
    as_of: datetime | None = None,
    date_of: Callable[[int], date] | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Run the whole daily load on each micro-batch.

    A batch is identified by its id, not by event time, so rows older than the ones
    already loaded are taken too.  Each job of a repeated batch that was committed
    before is skipped.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        daily_load(
            spark,
            lake,
            contract,
            dimensions,
            facts,
            _day_of(date_of, batch_id),
            as_of=as_of,
            raw=batch,
            batch_id=batch_id,
            use_watermark=False,
            stream_id=stream_identity(spark, checkpoint),
        )

    return _start(stream_source(spark, contract, incoming, files_per_batch), checkpoint, load)


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint; batch numbers count from 0 in each new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _day_of(date_of: Callable[[int], date] | None, batch_id: int) -> date:
    return date_of(batch_id) if date_of else utc_now().date()


def _start(
    source: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    return (
        source.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
