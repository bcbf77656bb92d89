"""From raw text columns to the contract's names, spellings and types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.contract import Contract, ContractError
from oreline.functions.text import parse_text

RAW = "_raw"


def rename_bulk(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present; ignore the others."""
    return df.withColumnsRenamed(dict(renames))


def normalized(column: str, spellings: Mapping[str, str | None]) -> Column:
    """Exact-match replacement; unmapped values and NULL stay.

    One literal map for a list of any length.  A spelling may be mapped to NULL.
    """
    value = F.col(column)
    if not spellings:
        return value
    pairs = [F.lit(text).cast("string") for pair in spellings.items() for text in pair]
    table = F.create_map(*pairs)
    return F.when(F.map_contains_key(table, value), F.try_element_at(table, value)).otherwise(value)


def normalize_values(
    df: DataFrame, normalizations: Mapping[str, Mapping[str, str | None]]
) -> DataFrame:
    """Replace bad spellings, column by column, in one projection."""
    return df.withColumns(
        {c: normalized(c, m) for c, m in normalizations.items() if c in df.columns and m}
    )


def contract_cast(df: DataFrame, contract: Contract, keep_raw: bool = False) -> DataFrame:
    """Type the contract's columns by name, in one projection.

    Extra columns pass through.  With ``keep_raw`` the untyped values stay beside
    them, in a struct.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c.name for c in contract.columns if c.name not in types]
    if missing:
        raise ContractError(f"source lacks contract columns {missing}")

    typed: dict[str, Column] = {}
    for rule in contract.columns:
        source = F.col(rule.name)
        is_text = isinstance(types[rule.name], T.StringType)
        typed[rule.name] = (
            parse_text(source, rule.data_type)
            if is_text
            else source.try_cast(rule.data_type)
        )
    names = [c.name for c in contract.columns]
    extras = [c for c in df.columns if c not in typed]
    if not keep_raw:
        return df.select(*[typed[c].alias(c) for c in names], *extras)

    raw = F.struct(*[F.col(c).cast("string").alias(c) for c in names])
    return df.select(*[typed[c].alias(c) for c in names], *extras, raw.alias(RAW))


def cast_failed(column: str) -> Column:
    """The text held something, but nothing the column's type can hold."""
    return F.col(f"{RAW}.`{column}`").isNotNull() & F.col(column).isNull()


def partition_literals(df: DataFrame, execution_date: date) -> DataFrame:
    """Add the execution date as ``year``, ``month`` and ``day`` text."""
    return df.withColumns(
        {
            "year": F.lit(f"{execution_date:%Y}"),
            "month": F.lit(f"{execution_date:%m}"),
            "day": F.lit(f"{execution_date:%d}"),
        }
    )


def conform(
    df: DataFrame,
    target: T.StructType,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The target's columns, by name, in its order and types.

    A column the frame lacks, or holds as NULL, takes its default.
    """
    defaults = defaults or {}
    present = set(df.columns)
    columns = []
    for f in target.fields:
        if f.name not in present and f.name not in defaults:
            raise ValueError(f"no value and no default for target column {f.name!r}")
        parts: list[Column] = []
        if f.name in present:
            parts.append(F.col(f.name).cast(f.dataType))
        if f.name in defaults:
            default = defaults[f.name]
            literal = default if isinstance(default, Column) else F.lit(default)
            parts.append(literal.cast(f.dataType))
        columns.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(f.name))
    return df.select(*columns)


def as_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as a string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in (columns or df.columns)])
