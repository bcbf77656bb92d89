"""Literals that do not depend on the session's or the driver's time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def quoted(name: str) -> str:
    """A column's name as expressions take it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
