"""Cleaning expressions and the declarative transform list."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.operators.clean import (
    conform,
    contract_cast,
    normalize_values,
    partition_literals,
    rename_bulk,
)
from oreline.operators.dedupe import dedupe_latest
from oreline.operators.transforms import (
    TransformContext,
    apply_handler,
    apply_transforms,
    handler,
)
from oreline.session import scratch_path
from oreline.sources.readers import read_csv
from oreline.suite.model import CONTRACT, DATE_STEPS
from oreline.suite.registry import query
from oreline.suite.views import events, raw_tx, table, tx, with_raw, with_tx

CONTEXT = TransformContext(
    execution_dt=datetime(2024, 6, 30), watermark=datetime(2024, 1, 15, 12, 30, 0, 250000)
)


def _steps(df, *steps):
    return apply_transforms(df, steps, CONTEXT)


@query(
    "rename_bulk",
    """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice AS total
FROM orders
""",
)
def _rename_bulk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    return rename_bulk(
        orders,
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "total",
         "not_there": "ignored"},
    )


@query(
    "normalize_values",
    """
SELECT c_custkey,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CARS' WHEN 'HOUSEHOLD' THEN 'HOME'
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
""",
)
def _normalize(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return normalize_values(
        customers,
        {"c_mktsegment": {"AUTOMOBILE": "CARS", "HOUSEHOLD": "HOME"}, "absent": {"a": "b"}},
    )


TYPED_SQL = """
SELECT id_type, TRY_CAST(id_number AS bigint) AS id_number, account_no, full_name, tx_type,
       TRY_CAST(amount AS decimal(18,2)) AS amount, product_type,
       CASE WHEN city = 'NATI0N_3' THEN 'NATION_3' ELSE city END AS city,
       TRY_CAST(event_ts AS timestamp) AS event_ts,
       TRY_CAST(birth_date AS timestamp) AS birth_date,
       TRY_CAST(risk_flag AS boolean) AS risk_flag,
       TRY_CAST(risk_amount AS decimal(18,2)) AS risk_amount,
       TRY_CAST(overdue_days AS integer) AS overdue_days
FROM raw
"""


def typed_tx(spark, sf_dir):
    return contract_cast(
        normalize_values(raw_tx(spark, sf_dir), CONTRACT.normalizations), CONTRACT
    )


@query("contract_cast", with_raw(TYPED_SQL))
def _contract_cast(spark, sf_dir):
    return typed_tx(spark, sf_dir)


@query(
    "partition_literals",
    "SELECT event_id, '2024' AS year, '06' AS month, '03' AS day FROM events",
)
def _partition_literals(spark, sf_dir):
    return partition_literals(events(spark, sf_dir).select("event_id"), date(2024, 6, 3))


@query("t_select", "SELECT event_id, user_id, ts FROM events")
def _select(spark, sf_dir):
    step = {"type": "select", "columns": ["event_id", "user_id", "ts"]}
    return _steps(events(spark, sf_dir), step)


@query(
    "t_cast",
    "SELECT event_id, CAST(user_id AS varchar) AS user_id, CAST(value AS decimal(18,2)) AS value FROM events",
)
def _cast(spark, sf_dir):
    return _steps(
        events(spark, sf_dir).select("event_id", "user_id", "value"),
        {"type": "cast", "column": "user_id", "target_type": "string"},
        {"type": "cast", "column": "value", "target_type": "decimal(18,2)"},
    )


@query("t_rename", "SELECT event_id AS id, ts AS happened_at FROM events")
def _rename(spark, sf_dir):
    return _steps(
        events(spark, sf_dir).select("event_id", "ts"),
        {"type": "rename", "from": "event_id", "to": "id"},
        {"type": "rename", "from": "ts", "to": "happened_at"},
    )


@query("t_to_date", "SELECT event_id, CAST(ts AS date) AS ts FROM events")
def _to_date(spark, sf_dir):
    step = {"type": "to_date", "column": "ts"}
    return _steps(events(spark, sf_dir).select("event_id", "ts"), step)


@query(
    "t_date_key",
    "SELECT l_orderkey, l_linenumber, CAST(strftime(l_shipdate, '%Y%m%d') AS integer) AS ship_key FROM lineitem",
)
def _date_key(spark, sf_dir):
    step = {"type": "add_date_key", "from_column": "l_shipdate", "output_col": "ship_key"}
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return _steps(lines, step).drop("l_shipdate")


_PARTS_SQL = """
       CAST(extract(year FROM {d}) AS smallint) AS {0},
       CAST(extract(month FROM {d}) AS smallint) AS {1},
       CAST(extract(day FROM {d}) AS smallint) AS {2},
       CAST(extract(quarter FROM {d}) AS smallint) AS {3},
       strftime({d}, '%B') AS {4}, strftime({d}, '%A') AS {5},
       dayofweek({d}) IN (0, 6) AS {6}
"""
ENGLISH_PARTS = ("year", "month", "day", "quarter", "month_name", "weekday_name", "is_weekend")
SPANISH_PARTS = (
    "anio", "mes", "dia", "trimestre", "nombre_mes", "dia_semana", "es_fin_de_semana",
)


def parts_sql(day: str, names=ENGLISH_PARTS) -> str:
    return _PARTS_SQL.format(*names, d=day)


@query(
    "t_date_parts",
    f"SELECT o_orderkey, {parts_sql('o_orderdate', SPANISH_PARTS)} FROM orders",
)
def _date_parts(spark, sf_dir):
    step = {"type": "generate_date_parts", "from_column": "o_orderdate"}
    return _steps(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), step
    ).drop("o_orderdate")


_HASHED = ("full_name", "city", "risk_flag", "risk_amount", "overdue_days", "birth_date")


@query(
    "t_hash",
    with_tx(
        "SELECT account_no, event_ts, id_number, sha256(concat_ws('|', "
        + ", ".join(f"CAST({c} AS varchar)" for c in _HASHED)
        + ")) AS compat_hash, sha256(concat_ws('|', "
        + ", ".join(
            f"coalesce(CAST(length(CAST({c} AS varchar)) AS varchar) || ':' || CAST({c} AS varchar), '~')"
            for c in _HASHED
        )
        + ")) AS safe_hash FROM tx"
    ),
)
def _hash(spark, sf_dir):
    columns = list(_HASHED)
    return _steps(
        tx(spark, sf_dir),
        {"type": "add_hash", "columns": columns, "output_col": "compat_hash", "mode": "compat"},
        {"type": "add_hash", "columns": columns, "output_col": "safe_hash"},
        {"type": "select",
         "columns": ["account_no", "event_ts", "id_number", "compat_hash", "safe_hash"]},
    )


@query(
    "t_exec_ts",
    "SELECT event_id, TIMESTAMP '2024-06-30 00:00:00' AS loaded_at FROM events",
)
def _exec_ts(spark, sf_dir):
    step = {"type": "add_execution_timestamp", "output_col": "loaded_at"}
    return _steps(events(spark, sf_dir).select("event_id"), step)


@query(
    "t_dedupe_latest",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1
""",
)
def _dedupe(spark, sf_dir):
    step = {"type": "deduplicate", "keys": ["user_id", "event_type"], "order_by": ["ts"]}
    return _steps(events(spark, sf_dir), step)


@query(
    "dedupe_ties",
    with_tx(
        """
SELECT id_type, id_number, max(city) AS city,
       max(struct_pack(c := city, p := product_type)).p AS product_type
FROM tx GROUP BY id_type, id_number
"""
    ),
)
def _dedupe_ties(spark, sf_dir):
    """Every customer has many rows with the same city; the other columns decide."""
    rows = tx(spark, sf_dir).select("id_type", "id_number", "city", "product_type")
    return dedupe_latest(rows, ["id_type", "id_number"], ["city"])


@query(
    "t_watermark",
    "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 12:30:00.250'",
)
def _watermark(spark, sf_dir):
    step = {"type": "watermark_filter", "column": "ts"}
    return _steps(events(spark, sf_dir).select("event_id", "ts"), step)


@query(
    "transform_chain",
    f"""
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS date) AS date FROM lineitem)
SELECT CAST(strftime(date, '%Y%m%d') AS integer) AS sk_date, date, {parts_sql('date')} FROM days
""",
)
def _chain(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "event_ts")
    return apply_transforms(lines, DATE_STEPS, CONTEXT)


@handler("suite_yearly_total")
def _yearly_total(df, config, ctx):
    """A handler that reshapes the output, as well as one that only writes, may be named."""
    return df.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count("*").alias("n_orders")
    )


@query(
    "custom_handler",
    """
SELECT CAST(extract(year FROM o_orderdate) AS integer) AS order_year, count(*) AS n_orders
FROM orders GROUP BY 1
""",
)
def _custom_handler(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return apply_handler("suite_yearly_total", orders, {"process_type": "orders"}, CONTEXT)


@query(
    "handler_csv_report",
    "SELECT CAST(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def _handler_report(spark, sf_dir):
    """The frame passes through; what is returned here is read back from the report."""
    config = {"process_type": "customers", "custom_output": {"path": scratch_path(spark, "report")}}
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    apply_handler("csv_report", customers, config, CONTEXT)
    return read_csv(spark, f"{config['custom_output']['path']}/customers")


@query(
    "conform_defaults",
    with_tx(
        """
SELECT account_no, CAST(amount AS decimal(20,2)) AS amount,
       coalesce(risk_amount, CAST(0 AS decimal(18,2))) AS risk_amount,
       coalesce(overdue_days, 0) AS overdue_days, 'RUNNING' AS status, TRUE AS is_active
FROM tx
"""
    ),
)
def _conform(spark, sf_dir):
    target = T.StructType(
        [
            T.StructField("account_no", T.StringType()),
            T.StructField("amount", T.DecimalType(20, 2)),
            T.StructField("risk_amount", T.DecimalType(18, 2)),
            T.StructField("overdue_days", T.IntegerType()),
            T.StructField("status", T.StringType()),
            T.StructField("is_active", T.BooleanType()),
        ]
    )
    defaults = {"risk_amount": 0, "overdue_days": 0, "status": "RUNNING", "is_active": True}
    return conform(tx(spark, sf_dir), target, defaults)


@query(
    "interval_arithmetic",
    "SELECT event_id, ts - INTERVAL 1 SECOND AS valid_to FROM events",
)
def _interval(spark, sf_dir):
    second = F.expr("interval 1 second")
    return events(spark, sf_dir).select("event_id", (F.col("ts") - second).alias("valid_to"))
