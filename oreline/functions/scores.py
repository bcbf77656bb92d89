"""Scoring expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

RISK_FACTOR = Decimal("0.7")


def risk_adjusted(amount: Column, flagged: Column, factor: Decimal = RISK_FACTOR) -> Column:
    """``amount`` times ``factor`` for flagged rows; an unknown flag costs nothing."""
    return F.when(flagged, amount * F.lit(factor)).otherwise(amount)
