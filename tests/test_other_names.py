"""The same jobs on a river-sampling model: other names, other chain of steps, and plain SQL over the result."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import types as T

from oreline.contract import contract_from_dict, load_contract
from oreline.operators.transforms import TransformError
from oreline.plans.gold import (
    ConfigError,
    gold_job,
    insert_schema,
    load_process,
    read_fact,
    scd2_schema,
    scd2_spec,
)
from oreline.plans.lake import Lake, read_appended, read_versions
from oreline.plans.silver import silver_job
from oreline.session import scratch_path

SAMPLES = {
    "source_name": "samples",
    "version": "7",
    "file_format": "csv",
    "delimiter": "|",
    "encoding": "utf-8-sig",
    "partition_keys": ["year", "month", "day"],
    "primary_key": ["bottle"],
    "columns": [
        {"name": "bottle", "spark_type": "StringType", "nullable": False},
        {"name": "gauge", "spark_type": "StringType", "nullable": False},
        {"name": "keeper", "spark_type": "StringType", "nullable": True},
        {"name": "substance", "spark_type": "StringType", "nullable": False, "valid_values": ["NITRATE", "LEAD"]},
        {"name": "micrograms", "spark_type": "DecimalType", "nullable": True, "precision": 12, "scale": 3, "min_value": 0},
        {"name": "drawn", "spark_type": "TimestampType", "nullable": False},
    ],
    "column_renames": {"µg/l": "micrograms", "drawn at": "drawn"},
    "normalizations": {"substance": {"NO3": "NITRATE"}},
    "quality_rules": {"min_valid_rate": 0.25},
}
VERSIONED = {"surrogate": "gauge_no", "hash": "print", "start": "since", "end": "till", "active": "current"}
GAUGES = {
    "process_type": "gauges",
    "source": {"source_name": "samples"},
    "transformations": [
        {"type": "deduplicate", "keys": ["gauge"], "order_by": ["drawn"]},
        {"type": "add_execution_timestamp", "output_col": "since"},
        {"type": "add_hash", "columns": ["keeper"], "output_col": "print", "mode": "compat"},
    ],
    "target": {
        "gold_path": "stage/gauges",
        "load": [{"step": "scd2", "table": "gauges", "keys": ["gauge"], "attributes": ["keeper"], "buckets": 3, "close": "half_open", **VERSIONED}],
    },
}
SUBSTANCES = {
    "process_type": "substances",
    "source": {"source_name": "samples"},
    "transformations": [{"type": "select", "columns": ["substance"]}],
    "target": {"gold_path": "stage/substances", "load": [{"step": "insert_new", "table": "substances", "key": ["substance"], "surrogate": "substance_no"}]},
}
READINGS = {
    "process_type": "readings",
    "source": {"source_name": "samples"},
    "transformations": [{"type": "cast", "column": "micrograms", "target_type": "decimal(12,1)"}],
    "target": {
        "gold_path": "stage/readings",
        "load": [
            {
                "step": "fact", "table": "readings", "surrogate": "reading_no", "date_key": "drawn_on", "event_time": "drawn",
                "key": ["bottle"], "measures": ["bottle", "micrograms", "drawn"],
                "lookups": [
                    {"table": "substances", "keys": ["substance"], "surrogate": "substance_no"},
                    {"table": "gauges", "keys": ["gauge"], "versioned": True, "close": "half_open", **VERSIONED},
                ],
            }
        ],
    },
}
ROUNDS = {
    date(2031, 3, 1): ["b1|Mill|Ana|NO3|12.34|2031-02-28 06:00:00", "b2|Ford||LEAD|0.5|2031-02-28 07:00:00", "b3|Ford||SALT|1|2031-02-28 08:00:00"],
    date(2031, 3, 8): ["b4|Mill|Bo|NITRATE|20|2031-03-07 06:00:00", "b5|Ford||LEAD|much|2031-03-07 07:00:00", "b6|Ford||NO3|8.06|2031-03-07 09:00:00"],
}


@pytest.fixture()
def sampled(spark, tmp_path):
    lake = Lake(spark, scratch_path(spark, "lake"))
    documents = {"samples": SAMPLES, "gauges": GAUGES, "substances": SUBSTANCES, "readings": READINGS}
    for name, document in documents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, ensure_ascii=False), encoding="utf-8")
    contract = load_contract(spark, str(tmp_path / "samples.json"))
    for when, lines in ROUNDS.items():
        source = tmp_path / f"{when}.txt"
        source.write_text("\n".join(["bottle|gauge|keeper|substance|µg/l|drawn at", *lines]), encoding="utf-8-sig")
        delivered = spark.read.option("header", True).option("sep", "|").csv(str(source))
        silver_job(spark, lake, contract, when, raw=delivered.toDF(*[c.lstrip("﻿") for c in delivered.columns]))
        for name in ("gauges", "substances", "readings"):
            gold_job(spark, lake, load_process(spark, str(tmp_path / f"{name}.json")), contract, when)
    return lake, contract


def test_versions_under_other_names(sampled):
    lake, contract = sampled
    staged = T.StructType([contract.schema["gauge"], contract.schema["keeper"], T.StructField("print", T.StringType()), T.StructField("since", T.TimestampNTZType())])
    versions = read_versions(lake, "gauges", scd2_schema(staged, scd2_spec(GAUGES["target"]["load"][0])))
    assert rows(versions.select("gauge_no", "gauge", "keeper", "till", "current")) == [
        (1, "Ford", None, None, True), (2, "Mill", "Ana", datetime(2031, 3, 8), False), (3, "Mill", "Bo", None, True),
    ]


def test_sql_over_the_loaded_tables(spark, sampled):
    lake, contract = sampled
    rounded = T.StructField("micrograms", T.DecimalType(12, 1))
    staged = T.StructType([rounded if f.name == rounded.name else f for f in contract.schema])
    read_fact(lake, READINGS, staged).createOrReplaceTempView("readings")
    known = insert_schema(T.StructType([contract.schema["substance"]]), {"surrogate": "substance_no"})
    read_appended(lake, "substances", known).createOrReplaceTempView("substances")
    change = spark.sql(
        """
        SELECT substance, bottle, micrograms - lag(micrograms) OVER (PARTITION BY substance_no ORDER BY drawn) AS rise
        FROM readings JOIN substances USING (substance_no) WHERE drawn_on >= :first
        """,
        args={"first": 20310201},
    )
    assert [(r.substance, r.bottle, r.rise and float(r.rise)) for r in change.orderBy("bottle").collect()] == [
        ("NITRATE", "b1", None), ("LEAD", "b2", None), ("NITRATE", "b4", 7.7), ("NITRATE", "b6", -11.9),
    ]


def test_warehouse_sql_must_become_load_steps(spark):
    lake, contract = Lake(spark, scratch_path(spark, "lake")), contract_from_dict(SAMPLES)
    config = {"process_type": "p", "source": {"source_name": "samples"}, "target": {"gold_path": "g", "sql_after_copy": ["..."]}}
    with pytest.raises(ConfigError, match="load steps"):
        gold_job(spark, lake, config, contract, date(2031, 3, 1))
    with pytest.raises(TransformError):
        gold_job(spark, lake, {**config, "transformations": [{"type": "x"}]}, contract, date(2031, 3, 1))
