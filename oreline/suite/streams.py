"""The same loads, fed by file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.plans.lake import Lake
from oreline.session import scratch_path
from oreline.sources.readers import read_csv
from oreline.streaming.ingest import stream_daily, stream_landing
from oreline.suite.jobs import (
    DELIVERED_SQL,
    FACT_SQL,
    FIRST_DAY,
    SECOND_DAY,
    as_delivered,
    customer_versions,
    deliveries,
    facts_of,
    fresh_lake,
)
from oreline.suite.model import AS_OF, CONTRACT, DIMENSIONS, FACTS
from oreline.suite.registry import query
from oreline.suite.views import raw_tx, with_raw


@query("stream_ingest", with_raw("SELECT *, 2024 AS year, 6 AS month, 3 AS day FROM raw"))
def _ingest(spark, sf_dir):
    """Land the files as they come; a second run of the stream finds nothing new."""
    lake, incoming = fresh_lake(spark), scratch_path(spark, "incoming")
    checkpoint = scratch_path(spark, "checkpoint")
    as_delivered(raw_tx(spark, sf_dir)).write.option("header", True).csv(incoming, compression="snappy")
    for _ in range(2):
        stream_landing(
            spark, lake, CONTRACT, incoming, checkpoint, F.lit("2024-06-03").cast("date")
        ).awaitTermination()
    landed = read_csv(spark, lake.bronze("transactions"))
    return landed.withColumnsRenamed(CONTRACT.column_renames)


def streamed_lake(spark, sf_dir) -> Lake:
    lake, incoming = fresh_lake(spark), scratch_path(spark, "incoming")
    checkpoint = scratch_path(spark, "checkpoint")
    for raw in deliveries(spark, sf_dir):
        raw.write.mode("append").option("header", True).csv(incoming)
        stream_daily(
            spark,
            lake,
            CONTRACT,
            DIMENSIONS,
            FACTS,
            incoming,
            checkpoint,
            as_of=AS_OF,
            date_of=lambda batch_id: SECOND_DAY if batch_id else FIRST_DAY,
        ).awaitTermination()
    return lake


@query("stream_incremental", FACT_SQL)
def _incremental(spark, sf_dir):
    return facts_of(streamed_lake(spark, sf_dir))


@query("stream_new_checkpoint", FACT_SQL)
def _new_checkpoint(spark, sf_dir):
    """Each delivery by a stream of its own: batches of one number are not taken for the same."""
    lake = fresh_lake(spark)
    for day, raw in zip((FIRST_DAY, SECOND_DAY), deliveries(spark, sf_dir)):
        incoming, checkpoint = scratch_path(spark, "incoming"), scratch_path(spark, "checkpoint")
        raw.write.option("header", True).csv(incoming)
        stream_daily(
            spark,
            lake,
            CONTRACT,
            DIMENSIONS,
            FACTS,
            incoming,
            checkpoint,
            as_of=AS_OF,
            date_of=lambda batch_id, day=day: day,
        ).awaitTermination()
    return facts_of(lake)


@query("stream_customers", DELIVERED_SQL + "SELECT * FROM versions")
def _customers(spark, sf_dir):
    return customer_versions(streamed_lake(spark, sf_dir))
