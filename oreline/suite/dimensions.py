"""Dimension maintenance on user states: one event day is one batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.text import row_hash
from oreline.operators.dedupe import dedupe_latest
from oreline.operators.dimensions import (
    Scd2,
    date_dimension,
    insert_if_new,
    scd2_history,
    scd2_merge,
)
from oreline.operators.keys import dense_keys, max_key
from oreline.session import materialize
from oreline.suite.registry import query
from oreline.suite.transforms import parts_sql
from oreline.suite.views import events, table

USER = Scd2(keys=("user_id",), attributes=("event_type", "value"), surrogate="sk_user")


def staged_users(source: DataFrame) -> DataFrame:
    """Each user's state at the end of each day it was seen."""
    daily = source.select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    return (
        dedupe_latest(daily, ["user_id", "day"], ["ts"])
        .withColumns(
            {
                "row_hash": row_hash(["event_type", "value"]),
                "valid_from": F.col("day").cast("timestamp_ntz"),
            }
        )
        .select(*USER.staged_columns)
    )


STAGED_SQL = """
states AS (
  SELECT user_id, event_type, CAST(value AS decimal(18,2)) AS value,
         CAST(CAST(ts AS date) AS timestamp) AS valid_from
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS date) ORDER BY ts DESC) = 1
), staged AS (
  SELECT *, sha256(length(event_type) || ':' || event_type || '|'
                   || length(CAST(value AS varchar)) || ':' || CAST(value AS varchar)) AS row_hash
  FROM states
)
"""

HISTORY_SQL = f"""
{STAGED_SQL}, opened AS (
  SELECT * FROM (
    SELECT *, lag(row_hash) OVER (PARTITION BY user_id ORDER BY valid_from) AS previous FROM staged)
  WHERE previous IS NULL OR previous <> row_hash
), history AS (
  SELECT row_number() OVER (ORDER BY valid_from, user_id) AS sk_user,
         user_id, event_type, value, row_hash, valid_from,
         lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) - INTERVAL 1 SECOND AS valid_to,
         lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) IS NULL AS is_active
  FROM opened
)
"""


@query("scd2_history", f"WITH {HISTORY_SQL} SELECT * FROM history")
def _history(spark, sf_dir):
    return scd2_history(staged_users(events(spark, sf_dir)), USER)


MERGE_SQL = f"""
WITH {STAGED_SQL}, latest AS (
  SELECT * FROM staged WHERE valid_from < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC) = 1
), active AS (
  SELECT row_number() OVER (ORDER BY user_id) AS sk_user, * FROM latest
), batch AS (
  SELECT * FROM staged WHERE valid_from = TIMESTAMP '2024-01-20'
), changes AS (
  SELECT b.* FROM batch b LEFT JOIN active a USING (user_id)
  WHERE a.row_hash IS NULL OR a.row_hash <> b.row_hash
)
SELECT a.sk_user, a.user_id, a.event_type, a.value, a.row_hash, a.valid_from,
       c.valid_from - INTERVAL 1 SECOND AS valid_to, c.user_id IS NULL AS is_active
FROM active a LEFT JOIN changes c USING (user_id)
UNION ALL
SELECT (SELECT count(*) FROM active) + row_number() OVER (ORDER BY user_id),
       user_id, event_type, value, row_hash, valid_from, NULL, TRUE
FROM changes
"""


@query("scd2_merge", MERGE_SQL)
def _merge(spark, sf_dir):
    staged = materialize(staged_users(events(spark, sf_dir)), "user-states")
    before = staged.where(F.col("valid_from") < F.lit("2024-01-20").cast("timestamp_ntz"))
    batch = staged.where(F.col("valid_from") == F.lit("2024-01-20").cast("timestamp_ntz"))
    known = dense_keys(dedupe_latest(before, ["user_id"], ["valid_from"]), "sk_user", ["user_id"])
    active = materialize(
        known.withColumns(
            {"valid_to": F.lit(None).cast("timestamp_ntz"), "is_active": F.lit(True)}
        ).select(*USER.columns),
        "active-users",
    )
    return scd2_merge(active, batch, USER, max_key(active, "sk_user"))


@query(
    "insert_new_product",
    """
WITH existing AS (
  SELECT row_number() OVER (ORDER BY p_brand, p_type) AS sk_product, p_brand, p_type
  FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 5)
)
SELECT * FROM existing
UNION ALL
SELECT (SELECT count(*) FROM existing) + row_number() OVER (ORDER BY p_brand, p_type), p_brand, p_type
FROM (SELECT DISTINCT p_brand, p_type FROM part) p
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.p_brand = p.p_brand AND e.p_type = p.p_type)
""",
)
def _insert_product(spark, sf_dir):
    key = ["p_brand", "p_type"]
    parts = table(spark, sf_dir, "part")
    small = parts.where(F.col("p_size") <= 5).select(*key).distinct()
    existing = materialize(dense_keys(small, "sk_product", key), "products")
    fresh = insert_if_new(
        existing, parts.select(*key), key, "sk_product", max_key(existing, "sk_product")
    )
    return existing.unionByName(fresh)


@query(
    "insert_new_date",
    f"""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS date) AS date FROM orders)
SELECT CAST(strftime(date, '%Y%m%d') AS integer) AS sk_date, date, {parts_sql('date')},
       date < DATE '1997-01-01' AS was_there
FROM days
""",
)
def _insert_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate")
    staged = date_dimension(orders, "o_orderdate")
    existing = staged.where(F.col("date") < F.lit(date(1997, 1, 1)))
    fresh = insert_if_new(existing, staged, ["sk_date"])
    return existing.withColumn("was_there", F.lit(True)).unionByName(
        fresh.withColumn("was_there", F.lit(False))
    )


@query(
    "surrogate_keys",
    "SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk_order, o_orderkey, o_custkey FROM orders",
)
def _keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_keys(orders, "sk_order", ["o_orderkey"], start=1000)
