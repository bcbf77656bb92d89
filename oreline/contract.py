"""Data contracts: what a delimited source holds and which rows are good."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T


class ContractError(ValueError):
    """The contract itself is wrong; no data was touched."""


# The type names a contract may use.
SIMPLE_TYPES: dict[str, T.DataType] = {
    "StringType": T.StringType(),
    "LongType": T.LongType(),
    "IntegerType": T.IntegerType(),
    "TimestampType": T.TimestampNTZType(),  # zone-less from end to end
    "BooleanType": T.BooleanType(),
}
DECIMAL_DEFAULT = (18, 2)
FILE_FORMATS = ("csv", "parquet", "json")


@dataclass(frozen=True)
class ColumnRule:
    name: str
    spark_type: str
    nullable: bool = True
    valid_values: tuple[str, ...] | None = None
    min_value: Decimal | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def data_type(self) -> T.DataType:
        if self.spark_type == "DecimalType":
            # A declared scale of 0 is a scale of 0.
            precision = DECIMAL_DEFAULT[0] if self.precision is None else self.precision
            scale = DECIMAL_DEFAULT[1] if self.scale is None else self.scale
            return T.DecimalType(precision, scale)
        try:
            return SIMPLE_TYPES[self.spark_type]
        except KeyError:
            raise ContractError(
                f"column {self.name!r}: unknown type {self.spark_type!r}"
            ) from None


@dataclass(frozen=True)
class QualityRules:
    min_valid_rate: float = 0.95
    reject_on_null_pk: bool = True
    reject_date_before: datetime | None = None
    reject_future_dates: bool = False
    date_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    source_name: str
    columns: tuple[ColumnRule, ...]
    primary_key: tuple[str, ...]
    partition_keys: tuple[str, ...] = ("year", "month", "day")
    version: str = "1"
    file_format: str = "csv"
    delimiter: str = ","
    encoding: str = "utf-8"
    column_renames: dict[str, str] = field(default_factory=dict)
    normalizations: dict[str, dict[str, str]] = field(default_factory=dict)
    quality_rules: QualityRules = QualityRules()

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise ContractError("a column is declared twice")
        known = set(names)
        for label, used in (
            ("primary_key", self.primary_key),
            ("date_columns", self.quality_rules.date_columns),
        ):
            unknown = [c for c in used if c not in known]
            if unknown:
                raise ContractError(f"{label} names unknown columns {unknown}")
        if not self.primary_key and self.quality_rules.reject_on_null_pk:
            raise ContractError("reject_on_null_pk needs a primary key")
        if self.file_format not in FILE_FORMATS:
            raise ContractError(f"file_format must be one of {FILE_FORMATS}")
        for column in self.columns:
            column.data_type  # raises on an unknown type

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.data_type, c.nullable) for c in self.columns]
        )

    @property
    def raw_headers(self) -> list[str]:
        """The header names expected in the file, in contract order."""
        by_clean = {clean: raw for raw, clean in self.column_renames.items()}
        return [by_clean.get(c.name, c.name) for c in self.columns]


def contract_from_dict(raw: dict[str, Any]) -> Contract:
    rules = raw.get("quality_rules", {})
    floor = rules.get("reject_date_before")
    try:
        columns = tuple(
            ColumnRule(
                name=c["name"],
                spark_type=c["spark_type"],
                nullable=c["nullable"],
                valid_values=tuple(c["valid_values"]) if c.get("valid_values") else None,
                min_value=(
                    None if c.get("min_value") is None else Decimal(str(c["min_value"]))
                ),
                precision=c.get("precision"),
                scale=c.get("scale"),
            )
            for c in raw["columns"]
        )
        return Contract(
            source_name=raw["source_name"],
            version=raw["version"],
            file_format=raw["file_format"],
            delimiter=raw["delimiter"],
            encoding=raw["encoding"],
            partition_keys=tuple(raw["partition_keys"]),
            primary_key=tuple(raw["primary_key"]),
            column_renames=dict(raw.get("column_renames", {})),
            columns=columns,
            normalizations=dict(raw.get("normalizations", {})),
            quality_rules=QualityRules(
                min_valid_rate=rules.get("min_valid_rate", 0.95),
                reject_on_null_pk=rules.get("reject_on_null_pk", True),
                reject_date_before=datetime.fromisoformat(floor) if floor else None,
                reject_future_dates=rules.get("reject_future_dates", False),
                date_columns=tuple(rules.get("date_columns", ())),
            ),
        )
    except KeyError as missing:
        raise ContractError(f"contract lacks {missing}") from None


def contract_from_json(text: str) -> Contract:
    return contract_from_dict(json.loads(text))


def load_contract(spark: SparkSession, path: str) -> Contract:
    """Read a contract document from anywhere Spark can read."""
    return contract_from_json(spark.read.text(path, wholetext=True).first()[0])
