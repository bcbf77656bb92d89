"""Key lookup, orphans, idempotent append, and the small aggregates of a load."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.operators.dimensions import scd2_history
from oreline.operators.facts import (
    lookup_active,
    lookup_as_of,
    lookup_key,
    not_loaded_yet,
    resolved,
)
from oreline.operators.keys import dense_keys
from oreline.session import materialize
from oreline.suite.dimensions import HISTORY_SQL, USER, staged_users
from oreline.suite.registry import query
from oreline.suite.views import events, table

ACTIVE_SQL = f"""
WITH {HISTORY_SQL}
SELECT e.event_id, e.user_id, e.ts, h.sk_user
FROM events e JOIN history h ON e.user_id = h.user_id AND h.is_active
"""

AS_OF_SQL = f"""
WITH {HISTORY_SQL}
SELECT e.event_id, e.user_id, e.ts, h.sk_user
FROM events e JOIN history h ON e.user_id = h.user_id AND e.ts >= h.valid_from
 AND (h.valid_to IS NULL OR e.ts < h.valid_to + INTERVAL 1 SECOND)
"""


def _users(spark, sf_dir):
    return materialize(scd2_history(staged_users(events(spark, sf_dir)), USER), "users")


def _facts(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "ts")


@query("lookup_active", ACTIVE_SQL)
def _active(spark, sf_dir):
    return lookup_active(_facts(spark, sf_dir), _users(spark, sf_dir), USER, "event_id")


@query("lookup_active_sliced", ACTIVE_SQL)
def _active_sliced(spark, sf_dir):
    """The same lookup as if the dimension were too large to broadcast."""
    return lookup_active(
        _facts(spark, sf_dir), _users(spark, sf_dir), USER, "event_id", broadcast_bytes=-1
    )


@query("lookup_as_of", AS_OF_SQL)
def _as_of(spark, sf_dir):
    return lookup_as_of(_facts(spark, sf_dir), _users(spark, sf_dir), USER, "ts", "event_id")


@query("lookup_as_of_sliced", AS_OF_SQL)
def _as_of_sliced(spark, sf_dir):
    return lookup_as_of(
        _facts(spark, sf_dir), _users(spark, sf_dir), USER, "ts", "event_id", broadcast_bytes=-1
    )


@query(
    "lookup_product",
    """
WITH products AS (
  SELECT row_number() OVER (ORDER BY p_type) AS sk_product, p_type
  FROM (SELECT DISTINCT p_type FROM part)
)
SELECT p_partkey, p_type, sk_product FROM part JOIN products USING (p_type)
""",
)
def _product(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    products = materialize(
        dense_keys(parts.select("p_type").distinct(), "sk_product", ["p_type"]), "products"
    )
    return lookup_key(parts, products, ["p_type"], "sk_product", "p_partkey")


@query(
    "lookup_orphans",
    f"""
WITH {HISTORY_SQL}, known AS (SELECT * FROM history WHERE user_id % 3 <> 0)
SELECT e.event_id, e.user_id, e.ts, k.sk_user, k.sk_user IS NOT NULL AS resolved
FROM events e LEFT JOIN known k ON e.user_id = k.user_id AND k.is_active
""",
)
def _orphans(spark, sf_dir):
    known = _users(spark, sf_dir).where(F.col("user_id") % 3 != 0)
    kept = lookup_active(_facts(spark, sf_dir), known, USER, "event_id", "left")
    return kept.withColumn("resolved", resolved(["sk_user"]))


@query("fact_append_idempotent", "SELECT event_id, user_id, ts, event_type FROM events")
def _append(spark, sf_dir):
    """Load up to the 20th, then reread from the 15th on: nothing comes twice."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    loaded = rows.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    overlap = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    fresh = not_loaded_yet(
        rows.where(overlap), loaded.where(overlap), ["user_id", "ts"], "event_id"
    )
    return loaded.unionByName(fresh)


@query("fact_append_sliced", "SELECT event_id, user_id, ts, event_type FROM events")
def _append_sliced(spark, sf_dir):
    """The same with an overlap too large to broadcast, and one hot key: the type."""
    rows = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    loaded = rows.where(F.col("event_type") != "error")
    fresh = not_loaded_yet(rows, loaded, ["event_type"], "event_id", broadcast_bytes=-1)
    return loaded.unionByName(fresh)


@query("max_watermark", "SELECT max(ts) AS watermark FROM events")
def _max_watermark(spark, sf_dir):
    return events(spark, sf_dir).agg(F.max("ts").alias("watermark"))


@query("row_count", "SELECT count(*) AS rows_read FROM lineitem")
def _row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows_read"))


@query("max_key", "SELECT coalesce(max(o_orderkey), 0) AS last_key FROM orders")
def _max_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("last_key"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def _distinct(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus", "l_shipdate"]
    return table(spark, sf_dir, "lineitem").select(*columns).distinct()
