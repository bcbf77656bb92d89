from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.scores import risk_adjusted
from oreline.functions.text import parse_text, row_hash


@pytest.mark.parametrize(
    "text, target, value",
    [
        ("12", T.LongType(), 12),
        (" 12 ", T.LongType(), 12),
        ("1.9", T.LongType(), 1),
        ("-1.9", T.LongType(), -1),
        (".5", T.IntegerType(), 0),
        ("7.", T.IntegerType(), 7),
        ("1.5e3", T.LongType(), None),
        ("99999999999999999999", T.LongType(), None),
        ("3000000000.5", T.IntegerType(), None),
        ("abc", T.IntegerType(), None),
        ("10.005", T.DecimalType(18, 2), Decimal("10.01")),
        ("n/a", T.DecimalType(18, 2), None),
        ("yes", T.BooleanType(), True),
        ("maybe", T.BooleanType(), None),
        ("2024-01-02 03:04:05.123456", T.TimestampNTZType(), datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024-01-02", T.TimestampNTZType(), datetime(2024, 1, 2)),
        ("2024-01-02T10:00:00+05:00", T.TimestampNTZType(), datetime(2024, 1, 2, 5)),
        ("2024-01-02T10:00:00Z", T.TimestampNTZType(), datetime(2024, 1, 2, 10)),
        ("2024-13-02", T.TimestampNTZType(), None),
        ("as is ", T.StringType(), "as is "),
        (None, T.LongType(), None),
    ],
)
def test_parse_text(spark, text, target, value):
    df = spark.createDataFrame([(text,)], "t string").select(parse_text(F.col("t"), target))
    assert df.first()[0] == value
    assert df.schema[0].dataType == target


@pytest.mark.parametrize("zone", ["America/Bogota", "Asia/Tokyo"])
def test_zoned_text_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-01-02T10:00:00+05:00",), ("2024-01-02 10:00:00",)], "t string")
        found = df.select(parse_text(F.col("t"), T.TimestampNTZType())).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in found] == [datetime(2024, 1, 2, 5), datetime(2024, 1, 2, 10)]


def test_safe_hash_tells_apart_what_compat_does_not(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("a|b", "c", None), ("a", "b|c", None)],
        "x string, y string, z string",
    )
    names = ["x", "y", "z"]
    assert df.select(row_hash(names, "compat")).distinct().count() == 2
    assert df.select(row_hash(names)).distinct().count() == 4
    with pytest.raises(ValueError):
        row_hash(names, "other")


def test_unknown_risk_costs_nothing(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "flag boolean")
    amount = F.lit(Decimal("10.00"))
    found = df.select("flag", risk_adjusted(amount, F.col("flag")).cast("decimal(10,2)").alias("s"))
    assert rows(found) == sorted(
        [(True, Decimal("7.00")), (False, Decimal("10.00")), (None, Decimal("10.00"))], key=repr
    )
