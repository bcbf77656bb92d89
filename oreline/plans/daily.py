"""The daily load: Silver, then the dimensions, then the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from oreline.contract import Contract
from oreline.plans.gold import gold_job
from oreline.plans.lake import GOLD, SILVER, Lake
from oreline.plans.silver import silver_job


def daily_load(
    spark: SparkSession,
    lake: Lake,
    contract: Contract,
    dimensions: Sequence[Mapping[str, Any]],
    facts: Sequence[Mapping[str, Any]],
    execution_date: date,
    as_of: datetime | None = None,
    raw: DataFrame | None = None,
    batch_id: int | None = None,
    use_watermark: bool = True,
    parallel_dimensions: int = 3,
    stream_id: str | None = None,
    null_policy: str = "strict",
    allow_empty: bool = False,
    lateness: timedelta = timedelta(0),
    options: Mapping[str, Any] | None = None,
    retries: int = 0,
) -> list[str]:
    """Load one day and return the run ids; the first failure stops all behind it.

    ``null_policy`` and ``allow_empty`` go to the Silver job, ``lateness`` to the facts, ``options`` and ``retries`` to all Gold jobs.

    The dimensions are independent jobs and share the cluster; facts wait for all
    of them, as they need the surrogate keys.
    """
    silver_id = _committed(lake, SILVER, contract.source_name, batch_id, stream_id)
    if silver_id is None:
        silver_id = silver_job(
            spark,
            lake,
            contract,
            execution_date,
            as_of=as_of,
            null_policy=null_policy,
            allow_empty=allow_empty,
            raw=raw,
            batch_id=batch_id,
            stream_id=stream_id,
        ).run_id

    def load(config: Mapping[str, Any], late: timedelta = timedelta(0)) -> str:
        done = _committed(lake, GOLD, config["process_type"], batch_id, stream_id)
        if done is not None:
            return done
        return gold_job(
            spark,
            lake,
            config,
            contract,
            execution_date,
            silver_run_id=silver_id,
            batch_id=batch_id,
            stream_id=stream_id,
            use_watermark=use_watermark,
            lateness=late,
            options=options,
            as_of=as_of,
            retries=retries,
        ).run_id

    with ThreadPoolExecutor(max_workers=parallel_dimensions) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(load), c) for c in dimensions]
        loaded = [task.result() for task in tasks]
    return [silver_id, *loaded, *[load(config, lateness) for config in facts]]


def _committed(
    lake: Lake, job: str, source: str, batch_id: int | None, stream_id: str | None
) -> str | None:
    """The run that already loaded this micro-batch; a plain day has none."""
    if batch_id is None:
        return None
    return lake.ledger.batch_run(job, source, batch_id, stream_id)
