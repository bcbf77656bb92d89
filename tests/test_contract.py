from __future__ import annotations

import copy
import json
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from oreline.contract import ContractError, contract_from_dict, contract_from_json, load_contract

RAW = {
    "source_name": "payments",
    "version": "1",
    "file_format": "csv",
    "delimiter": ";",
    "encoding": "utf-8",
    "partition_keys": ["year", "month", "day"],
    "primary_key": ["id"],
    "column_renames": {"número": "id"},
    "columns": [
        {"name": "id", "spark_type": "LongType", "nullable": False},
        {"name": "amount", "spark_type": "DecimalType", "nullable": False, "min_value": 0.5},
        {"name": "whole", "spark_type": "DecimalType", "nullable": True, "precision": 10, "scale": 0},
        {"name": "at", "spark_type": "TimestampType", "nullable": True},
        {"name": "n", "spark_type": "IntegerType", "nullable": True},
        {"name": "ok", "spark_type": "BooleanType", "nullable": True},
        {"name": "kind", "spark_type": "StringType", "nullable": True, "valid_values": ["A", "B"]},
    ],
}


def changed(**changes):
    raw = copy.deepcopy(RAW)
    raw.update(changes)
    return raw


def test_schema_types():
    types = {f.name: f.dataType for f in contract_from_dict(RAW).schema.fields}
    assert types == {
        "id": T.LongType(),
        "amount": T.DecimalType(18, 2),
        "whole": T.DecimalType(10, 0),  # a declared scale of 0 stays 0
        "at": T.TimestampNTZType(),
        "n": T.IntegerType(),
        "ok": T.BooleanType(),
        "kind": T.StringType(),
    }


def test_defaults_and_headers():
    contract = contract_from_json(json.dumps(RAW))
    assert contract.quality_rules.min_valid_rate == 0.95
    assert contract.quality_rules.reject_on_null_pk
    assert not contract.quality_rules.reject_future_dates
    assert contract.columns[1].min_value == Decimal("0.5")
    assert contract.raw_headers[0] == "número"


@pytest.mark.parametrize(
    "raw",
    [
        changed(columns=RAW["columns"] + [{"name": "x", "spark_type": "MapType", "nullable": True}]),
        changed(columns=RAW["columns"] + [RAW["columns"][0]]),
        changed(primary_key=["nobody"]),
        changed(primary_key=[]),
        changed(file_format="xml"),
        changed(quality_rules={"date_columns": ["nobody"]}),
        {k: v for k, v in RAW.items() if k != "delimiter"},
    ],
)
def test_bad_contracts_are_refused(raw):
    with pytest.raises(ContractError):
        contract_from_dict(raw)


def test_load_through_spark(spark, folder):
    with open(f"{folder}/contract.json", "w", encoding="utf-8") as out:
        json.dump(RAW, out, ensure_ascii=False)
    assert load_contract(spark, f"{folder}/contract.json") == contract_from_dict(RAW)
