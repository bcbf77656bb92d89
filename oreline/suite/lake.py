"""Sources, sinks, ledger and layout."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.ledger import (
    FAILED,
    RUNNING,
    SCHEMA,
    SUCCESS,
    Ledger,
    ledger_state,
    run_status,
    seeded_watermarks,
    watermark_state,
)
from oreline.operators.clean import conform, partition_literals
from oreline.operators.dimensions import date_dimension, insert_if_new
from oreline.operators.layout import sorted_layout
from oreline.operators.quality import REASONS, REJECTED, split
from oreline.session import as_nullable, scratch_path
from oreline.sources.readers import (
    BOM,
    arrival_audit,
    landed_files,
    on_day,
    read_csv,
    read_csv_by_header,
)
from oreline.sources.writers import land_raw, write_partitioned, write_rejects, write_report
from oreline.suite.quality import KEYS, strict_rows, with_outcomes
from oreline.suite.registry import query
from oreline.suite.views import events, raw_tx, table, with_raw


@query("csv_roundtrip", with_raw("SELECT * FROM raw"))
def _csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    raw = raw_tx(spark, sf_dir)
    raw.write.option("header", True).option("sep", ";").csv(path)
    return read_csv(spark, path, delimiter=";", headers=raw.columns)


@query("csv_bom_header", "SELECT CAST(c_custkey AS varchar) AS c_custkey, c_name FROM customer")
def _bom(spark, sf_dir):
    path = scratch_path(spark, "bom")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    marked = customers.withColumnRenamed("c_custkey", f"{BOM}c_custkey")
    marked.write.option("header", True).csv(path)
    return read_csv(spark, path, encoding="utf-8-sig")


def _two_headers(spark, sf_dir, second: list[str]) -> DataFrame:
    """Customers in files of two kinds below one folder, read back together."""
    path = scratch_path(spark, "csv")
    customers = table(spark, sf_dir, "customer").select(*CUSTOMER_TEXTS)
    even = F.col("c_custkey") % 2 == 0
    for part, columns in ((customers.where(even), CUSTOMER_TEXTS), (customers.where(~even), second)):
        part.select(*columns).write.mode("append").option("header", True).option("sep", "|").csv(path)
    return read_csv_by_header(spark, path, delimiter="|").select(*CUSTOMER_TEXTS)


CUSTOMER_TEXTS = ["c_custkey", "c_name", "c_mktsegment"]


@query(
    "csv_mixed_header_order",
    "SELECT CAST(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def _mixed_headers(spark, sf_dir):
    return _two_headers(spark, sf_dir, ["c_mktsegment", "c_custkey", "c_name"])


@query(
    "csv_missing_column",
    """
SELECT CAST(c_custkey AS varchar) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment
FROM customer
""",
)
def _missing_column(spark, sf_dir):
    return _two_headers(spark, sf_dir, ["c_name", "c_custkey"])


@query(
    "partitioned_sink_dynamic",
    """
SELECT event_id, value, '2024' AS year, '01' AS month, strftime(ts, '%d') AS day
FROM events WHERE CAST(ts AS date) <> DATE '2024-01-10'
UNION ALL
SELECT event_id, -value, '2024', '01', '10' FROM events WHERE CAST(ts AS date) = DATE '2024-01-10'
""",
)
def _dynamic(spark, sf_dir):
    """Write all days, then one day again: the others stay."""
    path = scratch_path(spark, "days")
    rows = events(spark, sf_dir).select(
        "event_id",
        "value",
        F.lit("2024").alias("year"),
        F.lit("01").alias("month"),
        F.lpad(F.dayofmonth("ts").cast("string"), 2, "0").alias("day"),
    )
    keys = ["year", "month", "day"]
    write_partitioned(rows, path, keys)
    again = rows.where(F.col("day") == "10").withColumn("value", -F.col("value"))
    write_partitioned(again, path, keys)
    return spark.read.schema(as_nullable(rows.schema)).parquet(path)


@query(
    "partition_scan",
    "SELECT event_id, ts FROM events WHERE CAST(ts AS date) = DATE '2024-01-10'",
)
def _scan(spark, sf_dir):
    path = scratch_path(spark, "days")
    rows = events(spark, sf_dir).select(
        "event_id", "ts", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    write_partitioned(rows, path, ["year", "month", "day"])
    return on_day(spark.read.parquet(path), date(2024, 1, 10)).select("event_id", "ts")


@query(
    "rejects_as_strings",
    with_outcomes(
        """
SELECT account_no, CAST(event_ts AS varchar) AS event_ts, CAST(id_number AS varchar) AS id_number,
       CAST(amount AS varchar) AS amount, raw_amount, reasons, '2024' AS year, '06' AS month, '03' AS day
FROM outcomes WHERE outcome = 'rejected'
"""
    ),
)
def _rejects(spark, sf_dir):
    path = scratch_path(spark, "rejects")
    rejected = split(strict_rows(spark, sf_dir))[REJECTED].select(
        *KEYS, F.col("_raw.amount").alias("raw_amount"), F.concat_ws(",", REASONS).alias("reasons")
    )
    write_rejects(partition_literals(rejected, date(2024, 6, 3)), path)
    schema = ", ".join(f"{c} string" for c in [*rejected.columns, "year", "month", "day"])
    return spark.read.schema(schema).parquet(path)


@query(
    "report_csv",
    """
SELECT o_orderstatus, CAST(count(*) AS varchar) AS n_orders FROM orders GROUP BY o_orderstatus
""",
)
def _report(spark, sf_dir):
    path = scratch_path(spark, "report")
    totals = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders")
    )
    write_report(totals, path, files=1)  # a handful of totals
    return read_csv(spark, path)


@query("gold_sink_reload", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'")
def _reload(spark, sf_dir):
    """A staging set is replaced as a whole by the next write."""
    path = f"{scratch_path(spark, 'gold')}/exec=2024-06-03"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for staged in (orders, orders.where(F.col("o_orderstatus") != "F").drop("o_orderstatus")):
        staged.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query(
    "merge_steps",
    """
SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS integer) AS sk_date, CAST(d AS date) AS date
FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem
      UNION ALL SELECT ts FROM events)
""",
)
def _merge_steps(spark, sf_dir):
    """Three insert-if-new steps in order, each seeing what the one before left."""
    dates = date_dimension(table(spark, sf_dir, "orders"), "o_orderdate").select("sk_date", "date")
    for name, column in (("lineitem", "l_shipdate"), ("events", "ts")):
        staged = date_dimension(table(spark, sf_dir, name), column).select("sk_date", "date")
        dates = dates.unionByName(insert_if_new(dates, staged, ["sk_date"]))
    return dates


@query(
    "arrival_audit",
    """
SELECT DISTINCT 'events' AS source_name, CAST(2024 AS integer) AS year, CAST(1 AS integer) AS month,
       CAST(extract(day FROM ts) AS integer) AS day
FROM events WHERE extract(day FROM ts) % 7 = 0
""",
)
def _arrival(spark, sf_dir):
    """Land all days but every seventh; the audit names the missing ones."""
    path = scratch_path(spark, "landing")
    rows = events(spark, sf_dir).select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    rows.where(F.col("day") % 7 != 0).write.option("header", True).partitionBy(
        "year", "month", "day"
    ).csv(path)
    source = F.lit("events").alias("source_name")
    expected = rows.select(source, "year", "month", "day").distinct()
    return arrival_audit(expected, landed_files(spark, path).select(source, "year", "month", "day"))


@query("land_raw", with_raw("SELECT *, 2024 AS year, 6 AS month, 3 AS day FROM raw"))
def _land(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    raw = raw_tx(spark, sf_dir)
    land_raw(raw, path, date(2024, 6, 3))
    return read_csv(spark, path)


def simulated_ledger(source: DataFrame) -> DataFrame:
    """Two events as one run: the even one opens it, the odd one ends it."""
    opens = F.col("event_id") % 2 == 0
    failed = F.col("event_type") == "error"
    succeeded = ~opens & ~failed
    return conform(
        source.select(
            F.concat(F.lit("run-"), F.floor(F.col("event_id") / 2).cast("string")).alias("run_id"),
            (F.col("event_id") % 2).alias("seq"),
            F.lit("gold").alias("job_name"),
            F.concat(F.lit("source-"), (F.col("user_id") % 10).cast("string")).alias("source_name"),
            F.concat(F.lit("source-"), (F.col("user_id") % 10).cast("string"))
            .alias("watermark_source"),
            F.to_date("ts").alias("execution_date"),
            F.col("ts").alias("started_at"),
            F.when(~opens, F.col("ts")).alias("finished_at"),
            F.when(succeeded, F.col("ts")).alias("watermark_end"),
            F.floor(F.col("value")).alias("rows_read"),
            F.when(opens, RUNNING).when(failed, FAILED).otherwise(SUCCESS).alias("status"),
            F.when(~opens & failed, F.col("props")).alias("error_msg"),
        ),
        SCHEMA,
        {
            "stream_id": None, "batch_id": None, "watermark_start": None, "rows_valid": 0, "rows_rejected": 0,
            "rows_indeterminate": 0, "rows_inserted": 0, "rows_updated": 0, "last_keys": None,
            "added": None, "removed": None, "version": None,
        },
    )


LEDGER_SQL = """
WITH ledger AS (
  SELECT 'run-' || CAST(event_id // 2 AS varchar) AS run_id, event_id % 2 AS seq,
         'source-' || CAST(user_id % 10 AS varchar) AS source_name, ts AS started_at,
         CAST(floor(value) AS bigint) AS rows_read,
         CASE WHEN event_id % 2 = 0 THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED'
              ELSE 'SUCCESS' END AS status,
         CASE WHEN event_id % 2 = 1 AND event_type = 'error' THEN props END AS error_msg
  FROM events
), state AS (
  SELECT * EXCLUDE (seq) FROM ledger
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY seq DESC) = 1
)
"""
STATE_COLUMNS = ["run_id", "source_name", "started_at", "rows_read", "status", "error_msg"]


@query("ledger_compacted", LEDGER_SQL + "SELECT * FROM state")
def _ledger_compacted(spark, sf_dir):
    """The same events as a log with checkpoints, read back behind some more runs of another job."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"), checkpoint=8)
    ledger.restore(simulated_ledger(events(spark, sf_dir)))
    for number in range(5):
        with ledger.run("later", f"source-{number}"):
            pass
    return ledger.state().where(F.col("job_name") == "gold").select(*STATE_COLUMNS)


@query("ledger_state", LEDGER_SQL + "SELECT * FROM state")
def _ledger_state(spark, sf_dir):
    return ledger_state(simulated_ledger(events(spark, sf_dir))).select(*STATE_COLUMNS)


@query("run_status", LEDGER_SQL + "SELECT * FROM state ORDER BY started_at DESC, run_id LIMIT 20")
def _run_status(spark, sf_dir):
    return run_status(simulated_ledger(events(spark, sf_dir)), 20).select(*STATE_COLUMNS)


@query(
    "watermark_state",
    LEDGER_SQL
    + """
SELECT source_name AS watermark_source, max(started_at) AS last_processed_ts,
       max(started_at) AS updated_at
FROM ledger WHERE status = 'SUCCESS' GROUP BY source_name
""",
)
def _watermark_state(spark, sf_dir):
    return watermark_state(simulated_ledger(events(spark, sf_dir)))


@query(
    "watermark_seeded",
    LEDGER_SQL
    + """
, sources AS (SELECT DISTINCT 'source-' || CAST(user_id % 20 AS varchar) AS source_name FROM events)
SELECT s.source_name, coalesce(max(started_at), TIMESTAMP '2000-01-01') AS last_processed_ts
FROM sources s LEFT JOIN (SELECT * FROM ledger WHERE status = 'SUCCESS') l USING (source_name)
GROUP BY s.source_name
""",
)
def _watermark_seeded(spark, sf_dir):
    rows = events(spark, sf_dir)
    sources = rows.select(
        F.concat(F.lit("source-"), (F.col("user_id") % 20).cast("string")).alias("source_name")
    ).distinct()
    return seeded_watermarks(sources, simulated_ledger(rows))


@query(
    "sorted_layout",
    """
SELECT l_orderkey, l_linenumber, l_shipdate,
       CAST(extract(year FROM l_shipdate) AS integer) AS ship_year
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01'
""",
)
def _layout(spark, sf_dir):
    """Lay the table out by time, then read a month of it."""
    path = scratch_path(spark, "layout")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.year("l_shipdate").alias("ship_year")
    )
    sorted_layout(rows, ["ship_year"], ["l_shipdate", "l_orderkey"]).write.partitionBy(
        "ship_year"
    ).parquet(path)
    month = F.lit("1998-03-01").cast("timestamp_ntz"), F.lit("1998-04-01").cast("timestamp_ntz")
    return spark.read.parquet(path).where(
        (F.col("ship_year") == 1998)
        & (F.col("l_shipdate") >= month[0])
        & (F.col("l_shipdate") < month[1])
    )
