"""Calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar names, independent of the JVM's locale.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
WEEKDAY_NAMES = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)

# Output column names of the calendar parts, per naming.
PART_NAMES = {
    "es": ("anio", "mes", "dia", "trimestre", "nombre_mes", "dia_semana",
           "es_fin_de_semana"),
    "en": ("year", "month", "day", "quarter", "month_name", "weekday_name",
           "is_weekend"),
}


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer, by arithmetic."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _name_of(names: Sequence[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def date_parts(day: Column, naming: str = "es") -> dict[str, Column]:
    """Year, month, day, quarter, their names, and the weekend flag."""
    if naming not in PART_NAMES:
        raise ValueError(f"naming must be one of {sorted(PART_NAMES)}, not {naming!r}")
    weekday = F.dayofweek(day)  # 1 is Sunday
    parts = [
        F.year(day).cast("smallint"),
        F.month(day).cast("smallint"),
        F.dayofmonth(day).cast("smallint"),
        F.quarter(day).cast("smallint"),
        _name_of(MONTH_NAMES, F.month(day)),
        _name_of(WEEKDAY_NAMES, weekday),
        weekday.isin(1, 7),
    ]
    return dict(zip(PART_NAMES[naming], parts))
