"""Named DataFrame transforms that a process configuration lists in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.dates import date_key, date_parts
from oreline.functions.literals import instant
from oreline.functions.text import parse_text, row_hash
from oreline.operators.dedupe import dedupe_latest


class TransformError(ValueError):
    """The transform list is wrong; no data was touched."""


@dataclass(frozen=True)
class TransformContext:
    """Run-time values that transforms may need.

    ``options`` sets defaults for steps that do not say: ``hash_mode`` ("safe" or
    "compat") and ``date_naming`` ("es" or "en").
    """

    execution_dt: datetime | None = None
    watermark: datetime | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


Step = Mapping[str, Any]
Transform = Callable[[DataFrame, Step, TransformContext], DataFrame]
Handler = Callable[[DataFrame, Mapping[str, Any], TransformContext], DataFrame]

_transforms: dict[str, tuple[Transform, tuple[str, ...]]] = {}
_handlers: dict[str, Handler] = {}


def transform(name: str, *required: str) -> Callable[[Transform], Transform]:
    """Register a transform and the settings a step must give it."""

    def register(function: Transform) -> Transform:
        _transforms[name] = (function, required)
        return function

    return register


def handler(name: str) -> Callable[[Handler], Handler]:
    """Register a custom handler under the name that configurations use."""

    def register(function: Handler) -> Handler:
        _handlers[name] = function
        return function

    return register


def transform_names() -> list[str]:
    return sorted(_transforms)


@transform("select", "columns")
def _select(df, step, ctx):
    return df.select(*step["columns"])


@transform("deduplicate", "keys")
def _deduplicate(df, step, ctx):
    return dedupe_latest(df, step["keys"], step.get("order_by", ()))


@transform("add_hash", "columns", "output_col")
def _add_hash(df, step, ctx):
    mode = step.get("mode", ctx.options.get("hash_mode", "safe"))
    return df.withColumn(step["output_col"], row_hash(step["columns"], mode))


@transform("add_execution_timestamp", "output_col")
def _add_execution_timestamp(df, step, ctx):
    return df.withColumn(step["output_col"], instant(ctx.execution_dt))


@transform("to_date", "column")
def _to_date(df, step, ctx):
    return df.withColumn(step["column"], F.to_date(step["column"]))


@transform("add_date_key", "from_column", "output_col")
def _add_date_key(df, step, ctx):
    return df.withColumn(step["output_col"], date_key(F.col(step["from_column"])))


@transform("generate_date_parts", "from_column")
def _generate_date_parts(df, step, ctx):
    naming = step.get("naming", ctx.options.get("date_naming", "es"))
    return df.withColumns(date_parts(F.col(step["from_column"]), naming))


@transform("watermark_filter", "column")
def _watermark_filter(df, step, ctx):
    if ctx.watermark is None:
        return df
    return df.where(F.col(step["column"]) > instant(ctx.watermark))


@transform("cast", "column", "target_type")
def _cast(df, step, ctx):
    value = F.col(step["column"])
    if isinstance(df.schema[step["column"]].dataType, T.StringType):
        target = T.DataType.fromDDL(step["target_type"])
        return df.withColumn(step["column"], parse_text(value, target))
    return df.withColumn(step["column"], value.try_cast(step["target_type"]))


@transform("rename", "from", "to")
def _rename(df, step, ctx):
    return df.withColumnRenamed(step["from"], step["to"])


def check_transforms(steps: Sequence[Step], ctx: TransformContext) -> None:
    """Refuse a bad list before any of it runs."""
    for position, step in enumerate(steps):
        name = step.get("type")
        if name not in _transforms:
            raise TransformError(f"step {position}: unknown transform {name!r}")
        missing = [r for r in _transforms[name][1] if r not in step]
        if missing:
            raise TransformError(f"step {position} ({name}): missing settings {missing}")
        if name == "add_execution_timestamp" and ctx.execution_dt is None:
            raise TransformError(f"step {position} ({name}): no execution time in the context")


def apply_transforms(
    df: DataFrame, steps: Sequence[Step], ctx: TransformContext | None = None
) -> DataFrame:
    """Apply the steps in order; the result is one lazy plan."""
    ctx = ctx or TransformContext()
    check_transforms(steps, ctx)
    for step in steps:
        df = _transforms[step["type"]][0](df, step, ctx)
    return df


def apply_handler(
    name: str, df: DataFrame, config: Mapping[str, Any], ctx: TransformContext
) -> DataFrame:
    if name not in _handlers:
        raise TransformError(f"unknown handler {name!r}; registered: {sorted(_handlers)}")
    return _handlers[name](df, config, ctx)
