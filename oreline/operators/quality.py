"""Row rules, the three-way split, its metrics and the valid-rate gate.

A rule is a named boolean ``Column``: true passes, false fails, NULL is
undecided.  Two null policies exist:

``strict``  a NULL passes in a nullable column and fails in any other; text that
            did not parse fails.
``sql``     plain SQL comparison: a NULL leaves the rule undecided, and the row
            goes to the ``indeterminate`` output instead of vanishing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.contract import Contract
from oreline.functions.literals import instant
from oreline.operators.clean import cast_failed
from oreline.session import fill_defaults, materialize

OUTCOME = "_outcome"
REASONS = "_reasons"
VALID, REJECTED, INDETERMINATE = "valid", "rejected", "indeterminate"
NULL_POLICIES = ("strict", "sql")
REASON_SEPARATOR = "\x1f"


class QualityGateError(RuntimeError):
    """Too few valid rows; the evidence was written before this was raised."""


@dataclass(frozen=True)
class RowMetrics:
    rows_read: int
    rows_valid: int
    rows_rejected: int
    rows_indeterminate: int

    @property
    def valid_rate(self) -> float:
        return self.rows_valid / self.rows_read if self.rows_read else 0.0


def pk_not_null(contract: Contract) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in contract.primary_key])


def row_rules(
    contract: Contract,
    as_of: datetime | None = None,
    null_policy: str = "strict",
    with_cast_failures: bool = False,
) -> dict[str, Column]:
    """The contract's rules by name, in a fixed order."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    strict = null_policy == "strict"
    quality = contract.quality_rules
    utc_now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    now = instant(as_of) if as_of else utc_now
    rules: dict[str, Column] = {}

    def null_passes(column: str, test: Column) -> Column:
        return F.col(column).isNull() | test

    if quality.reject_on_null_pk:
        rules["pk_not_null"] = pk_not_null(contract)
    if strict:
        for c in contract.columns:
            if not c.nullable:
                rules[f"not_null:{c.name}"] = F.col(c.name).isNotNull()
        if with_cast_failures:
            for c in contract.columns:
                if not isinstance(c.data_type, T.StringType):
                    rules[f"cast_failed:{c.name}"] = ~cast_failed(c.name)
    for c in contract.columns:
        if c.valid_values:
            test = F.col(c.name).isin(*c.valid_values)
            rules[f"allowed:{c.name}"] = null_passes(c.name, test) if strict else test
    for c in contract.columns:
        if c.min_value is not None:
            test = F.col(c.name) >= F.lit(c.min_value)
            rules[f"min:{c.name}"] = null_passes(c.name, test) if strict else test
    for name in quality.date_columns:
        if quality.reject_date_before:
            rules[f"date_floor:{name}"] = null_passes(
                name, F.col(name) >= instant(quality.reject_date_before)
            )
        if quality.reject_future_dates:
            rules[f"no_future:{name}"] = null_passes(name, F.col(name) <= now)
    return rules


def flag_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the outcome and the names of the rules a row failed.

    An undecided rule is listed with a question mark.
    """
    fill_defaults(df.sparkSession)
    names = list(rules)
    held = F.array(*[rules[n] for n in names]) if names else F.array().cast("array<boolean>")
    tested = df.withColumn("_held", held)
    passes = [F.col("_held")[i] for i in range(len(names))]
    flag = reduce(Column.__and__, passes, F.lit(True))
    verdicts = F.create_map(F.lit(True), F.lit(VALID), F.lit(False), F.lit(REJECTED))
    reasons = [
        F.when(~p, F.lit(n)).when(p.isNull(), F.lit(f"{n}?")) for n, p in zip(names, passes)
    ]
    # concat_ws skips NULLs in generated code; filtering an array would be interpreted.
    # Each reason is named once; text that repeats in a plan is computed again.
    listed = F.split(F.concat_ws(REASON_SEPARATOR, *reasons), REASON_SEPARATOR)
    return tested.withColumns(
        {
            # A lookup names the flag once; a CASE would repeat every rule.
            OUTCOME: F.coalesce(F.try_element_at(verdicts, flag), F.lit(INDETERMINATE)),
            REASONS: F.array_remove(listed, ""),
        }
    ).drop("_held")


def split(flagged: DataFrame) -> dict[str, DataFrame]:
    """One frame per outcome.  The rows are judged once and written by outcome."""
    judged = materialize(flagged, "judged", [OUTCOME])
    return {
        outcome: judged.where(F.col(OUTCOME) == outcome)
        for outcome in (VALID, REJECTED, INDETERMINATE)
    }


def metrics_frame(flagged: DataFrame) -> DataFrame:
    """Read, valid, rejected and indeterminate counts in one pass."""
    outcome = F.col(OUTCOME)
    return flagged.agg(
        F.count("*").alias("rows_read"),
        F.count_if(outcome == VALID).alias("rows_valid"),
        F.count_if(outcome == REJECTED).alias("rows_rejected"),
        F.count_if(outcome == INDETERMINATE).alias("rows_indeterminate"),
    )


def gate_frame(metrics: DataFrame, min_valid_rate: float, allow_empty: bool = False) -> DataFrame:
    """Valid rate and verdict next to the counts."""
    read = F.col("rows_read")
    rate = F.when(read > 0, F.col("rows_valid") / read).otherwise(F.lit(0.0))
    passed = rate >= F.lit(float(min_valid_rate))
    if allow_empty:
        passed = passed | (read == 0)
    return metrics.select("*", rate.alias("valid_rate"), passed.alias("gate_passed"))


def check_gate(metrics: RowMetrics, contract: Contract, allow_empty: bool = False) -> None:
    minimum = contract.quality_rules.min_valid_rate
    if allow_empty and metrics.rows_read == 0:
        return
    if metrics.valid_rate < minimum:
        raise QualityGateError(
            f"valid rate {metrics.valid_rate:.2%} is below the required {minimum:.2%}"
        )


def rule_breakdown(flagged: DataFrame) -> DataFrame:
    """How many rows failed each rule; a row counts once per rule it failed.

    The outer explode keeps the optimizer from copying all rules into a filter.
    """
    return (
        flagged.select(F.explode_outer(REASONS).alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("n_rows"))
    )
