"""Whole jobs on a fresh lake: CSV in, committed tables out."""

from __future__ import annotations

import copy
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.operators.dimensions import date_dimension
from oreline.operators.transforms import handler
from oreline.plans.daily import daily_load
from oreline.plans.gold import gold_job, insert_schema, read_fact, replay_orphans, scd2_schema
from oreline.plans.lake import (
    Lake,
    read_appended,
    read_rejects,
    read_silver,
    read_versions,
)
from oreline.plans.silver import silver_job
from oreline.session import scratch_path
from oreline.sources.writers import land_raw
from oreline.suite.model import (
    AS_OF,
    CONTRACT,
    CUSTOMER,
    CUSTOMER_ATTRIBUTES,
    CUSTOMER_KEYS,
    CUSTOMER_PROCESS,
    DATE_PROCESS,
    DIMENSIONS,
    FACT_PROCESS,
    FACTS,
    PRODUCT_PROCESS,
)
from oreline.suite.quality import STRICT_SQL, STRICT_TYPED_SQL, with_outcomes
from oreline.suite.registry import query
from oreline.suite.transforms import parts_sql
from oreline.suite.views import RAW_SQL, TX_SQL, raw_tx

FIRST_DAY, SECOND_DAY = date(2024, 1, 1), date(2024, 1, 2)
TYPED_COLUMNS = CONTRACT.schema.names


def as_delivered(raw: DataFrame) -> DataFrame:
    """The raw rows under the headers of the source's files."""
    return raw.withColumnsRenamed({c: r for r, c in CONTRACT.column_renames.items()})


def fresh_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


def _loaded_silver(spark: SparkSession, sf_dir: str):
    lake = fresh_lake(spark)
    land_raw(as_delivered(raw_tx(spark, sf_dir)), lake.bronze("transactions"), FIRST_DAY)
    return lake, silver_job(spark, lake, CONTRACT, FIRST_DAY, as_of=AS_OF)


@query(
    "silver_job",
    with_outcomes(
        f"SELECT {', '.join(TYPED_COLUMNS)}, '2024' AS year, '01' AS month, '01' AS day"
        " FROM outcomes WHERE outcome = 'valid'"
    ),
)
def _silver(spark, sf_dir):
    lake, _ = _loaded_silver(spark, sf_dir)
    return read_silver(lake, CONTRACT, FIRST_DAY)


@query(
    "silver_rejects",
    with_outcomes(
        """
SELECT raw_id_number AS id_number, account_no, raw_amount AS amount, raw_birth_date AS birth_date,
       city, reasons
FROM outcomes WHERE outcome = 'rejected'
"""
    ),
)
def _silver_rejects(spark, sf_dir):
    lake, run = _loaded_silver(spark, sf_dir)
    rejects = read_rejects(lake, CONTRACT, run.run_id)
    return rejects.select(
        "id_number", "account_no", "amount", "birth_date", "city",
        F.concat_ws(",", "reasons").alias("reasons"),
    )


@query(
    "gold_job",
    with_outcomes(
        f"""
, days AS (SELECT DISTINCT CAST(event_ts AS date) AS date FROM outcomes WHERE outcome = 'valid')
SELECT CAST(strftime(date, '%Y%m%d') AS integer) AS sk_date, date, {parts_sql('date')} FROM days
"""
    ),
)
def _gold(spark, sf_dir):
    lake, _ = _loaded_silver(spark, sf_dir)
    gold_job(spark, lake, DATE_PROCESS, CONTRACT, FIRST_DAY)
    schema = date_dimension(read_silver(lake, CONTRACT, FIRST_DAY), "event_ts").schema
    return read_appended(lake, "dim_date", insert_schema(schema, {}))


# Two deliveries.  In the second one every fifth customer has moved.
SPLIT_AT = "1999-01-01 00:00:00"


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    raw = raw_tx(spark, sf_dir)
    first = F.col("event_ts") < SPLIT_AT
    moved = F.when(F.col("id_number").cast("bigint") % 5 == 0, F.lit("MOVED TOWN"))
    later = raw.where(~first).withColumn("city", F.coalesce(moved, F.col("city")))
    return [as_delivered(raw.where(first)), as_delivered(later)]


DELIVERED_SQL = f"""
WITH tx AS ({TX_SQL}), delivered AS ({RAW_SQL}), raw AS (
  SELECT * REPLACE (
    CASE WHEN event_ts >= '{SPLIT_AT}' AND CAST(id_number AS bigint) % 5 = 0
         THEN 'MOVED TOWN' ELSE city END AS city)
  FROM delivered
), typed AS ({STRICT_TYPED_SQL}) {STRICT_SQL}, loaded AS (
  SELECT *, CASE WHEN event_ts < TIMESTAMP '{SPLIT_AT}' THEN TIMESTAMP '2024-01-01'
                 ELSE TIMESTAMP '2024-01-02' END AS batch
  FROM outcomes WHERE outcome = 'valid'
), states AS (
  SELECT DISTINCT id_type, id_number, full_name, city, CAST(birth_date AS date) AS birth_date,
         risk_flag, risk_amount, overdue_days, batch
  FROM loaded
), opened AS (
  SELECT * FROM (
    SELECT *, lag(city) OVER (PARTITION BY id_type, id_number ORDER BY batch) AS before FROM states)
  WHERE before IS NULL OR before <> city
), versions AS (
  SELECT row_number() OVER (ORDER BY batch, id_type, id_number) AS sk_customer,
         id_type, id_number, full_name, city, birth_date, risk_flag, risk_amount, overdue_days,
         batch AS valid_from,
         lead(batch) OVER (PARTITION BY id_type, id_number ORDER BY batch) - INTERVAL 1 SECOND AS valid_to,
         lead(batch) OVER (PARTITION BY id_type, id_number ORDER BY batch) IS NULL AS is_active
  FROM opened
)
"""

FACT_SQL = DELIVERED_SQL + """
, products AS (
  SELECT row_number() OVER (ORDER BY batch, product_type) AS sk_product, product_type
  FROM (SELECT product_type, min(batch) AS batch FROM loaded GROUP BY product_type)
)
SELECT v.sk_customer, p.sk_product, CAST(strftime(l.event_ts, '%Y%m%d') AS integer) AS sk_date,
       l.account_no, l.tx_type, l.amount, l.event_ts,
       CAST(extract(year FROM l.event_ts) * 100 + extract(month FROM l.event_ts) AS integer) AS month_key
FROM loaded l JOIN products p USING (product_type)
JOIN versions v ON v.id_type = l.id_type AND v.id_number = l.id_number
 AND l.batch >= v.valid_from AND (v.valid_to IS NULL OR l.batch < v.valid_to)
"""


def loaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Both deliveries, each through the whole daily load."""
    lake = fresh_lake(spark)
    for day, raw in zip((FIRST_DAY, SECOND_DAY), deliveries(spark, sf_dir)):
        land_raw(raw, lake.bronze("transactions"), day)
        daily_load(spark, lake, CONTRACT, DIMENSIONS, FACTS, day, as_of=AS_OF)
    return lake


def facts_of(lake: Lake) -> DataFrame:
    rows = read_fact(lake, FACT_PROCESS, CONTRACT.schema)
    return rows.drop("sk_transaction")


def customer_versions(lake: Lake) -> DataFrame:
    types = {f.name: f.dataType for f in CONTRACT.schema.fields}
    types |= {"birth_date": T.DateType(), "row_hash": T.StringType()}
    types |= {"valid_from": T.TimestampNTZType()}
    staged = T.StructType([T.StructField(c, types[c], True) for c in CUSTOMER.staged_columns])
    versions = read_versions(lake, "dim_customer", scd2_schema(staged, CUSTOMER))
    return versions.select(
        "sk_customer", *CUSTOMER_KEYS, *CUSTOMER_ATTRIBUTES, "valid_from", "valid_to", "is_active"
    )


@query("daily_load_facts", FACT_SQL)
def _daily_facts(spark, sf_dir):
    return facts_of(loaded_lake(spark, sf_dir))


@query("daily_load_customers", DELIVERED_SQL + "SELECT * FROM versions")
def _daily_customers(spark, sf_dir):
    return customer_versions(loaded_lake(spark, sf_dir))


LIST_PROCESS = {
    "process_type": "customer_list",
    "source": {"source_name": "transactions"},
    "transformations": [{"type": "select", "columns": [*CUSTOMER_KEYS]}],
    "target": {
        "gold_path": "stg_customer_list",
        "load": [{"step": "insert_new", "table": "customer_list", "key": [*CUSTOMER_KEYS], "surrogate": "sk_customer"}],
    },
}


@query(
    "concurrent_keys",
    DELIVERED_SQL
    + """
, quick AS (SELECT DISTINCT id_type, id_number FROM loaded WHERE batch = TIMESTAMP '2024-01-02')
, slow AS (SELECT id_type, id_number FROM loaded WHERE batch = TIMESTAMP '2024-01-01' EXCEPT SELECT * FROM quick)
SELECT row_number() OVER (ORDER BY late, id_type, id_number) AS sk_customer, id_type, id_number
FROM (SELECT 0 AS late, * FROM quick UNION ALL SELECT 1 AS late, * FROM slow)
""",
)
def _concurrent_keys(spark, sf_dir):
    """The first day's load is overtaken by the second day's, loses, and is repeated."""
    lake = fresh_lake(spark)
    for day, raw in zip((FIRST_DAY, SECOND_DAY), deliveries(spark, sf_dir)):
        silver_job(spark, lake, CONTRACT, day, as_of=AS_OF, raw=raw)
    overtaken = []

    @handler("overtaken_once")
    def overtake(staged: DataFrame, config, ctx) -> DataFrame:
        if not overtaken:
            overtaken.append(gold_job(spark, lake, LIST_PROCESS, CONTRACT, SECOND_DAY))
        return staged

    gold_job(spark, lake, {**LIST_PROCESS, "custom_handler": "overtaken_once"}, CONTRACT, FIRST_DAY, retries=1)
    keys = T.StructType([CONTRACT.schema[k] for k in CUSTOMER_KEYS])
    return read_appended(lake, "customer_list", insert_schema(keys, {"surrogate": "sk_customer"}))


THIRD_DAY = date(2024, 1, 3)


@query(
    "scd2_touched_buckets",
    DELIVERED_SQL.replace(
        "), opened AS (",
        """
  UNION ALL
  SELECT DISTINCT id_type, id_number, full_name, 'LAST TOWN', CAST(birth_date AS date), risk_flag, risk_amount,
         overdue_days, TIMESTAMP '2024-01-03'
  FROM loaded WHERE batch = TIMESTAMP '2024-01-02' AND id_number % 7 = 0
), opened AS (""",
    )
    + "SELECT * FROM versions",
)
def _touched_buckets(spark, sf_dir):
    """Three days into one versioned table; each day rewrites the buckets of the customers that changed."""
    lake = fresh_lake(spark)
    first, second = deliveries(spark, sf_dir)
    number = next(h for h, c in CONTRACT.column_renames.items() if c == "id_number")
    third = second.where(F.col(number).cast("bigint") % 7 == 0).withColumn("city", F.lit("LAST TOWN"))
    for day, raw in zip((FIRST_DAY, SECOND_DAY, THIRD_DAY), (first, second, third)):
        silver_job(spark, lake, CONTRACT, day, as_of=AS_OF, raw=raw, allow_empty=True)
        gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, day)
    return customer_versions(lake)


#: Every fact under its customer's first version.
FIRST_VERSION_SQL = FACT_SQL.replace(
    "JOIN versions v ON v.id_type = l.id_type AND v.id_number = l.id_number\n"
    " AND l.batch >= v.valid_from AND (v.valid_to IS NULL OR l.batch < v.valid_to)",
    "JOIN (SELECT *, row_number() OVER (PARTITION BY id_type, id_number ORDER BY valid_from) AS nth FROM versions) v\n"
    "  ON v.id_type = l.id_type AND v.id_number = l.id_number AND nth = 1",
)


@query("daily_load_as_of", FIRST_VERSION_SQL)
def _daily_as_of(spark, sf_dir):
    """Both deliveries with lookups by event time: all events lie before the first load, so first versions reach back."""
    config = copy.deepcopy(FACT_PROCESS)
    next(d for d in config["target"]["load"][0]["lookups"] if d.get("versioned")).update(as_of=True, open_start=True)
    lake = fresh_lake(spark)
    for day, raw in zip((FIRST_DAY, SECOND_DAY), deliveries(spark, sf_dir)):
        daily_load(spark, lake, CONTRACT, DIMENSIONS, [config], day, as_of=AS_OF, raw=raw)
    return facts_of(lake)


@query("orphans_replayed", FIRST_VERSION_SQL)
def _orphans_replayed(spark, sf_dir):
    """Facts of the second day are loaded before its customers; a replay finds those who were missing, once."""
    lake = fresh_lake(spark)
    days = (FIRST_DAY, SECOND_DAY)
    for day, raw in zip(days, deliveries(spark, sf_dir)):
        silver_job(spark, lake, CONTRACT, day, as_of=AS_OF, raw=raw)
    gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, FIRST_DAY)
    for day in days:
        gold_job(spark, lake, PRODUCT_PROCESS, CONTRACT, day)
        gold_job(spark, lake, FACT_PROCESS, CONTRACT, day, as_of=AS_OF)
    replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, SECOND_DAY)
    gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, SECOND_DAY)
    for _ in range(2):
        replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, SECOND_DAY)
    return facts_of(lake)


SUMMARY_PROCESS = {
    "process_type": "product_months",
    "source": {"source_name": "transactions"},
    "transformations": [{"type": "select", "columns": ["product_type"]}],
    "target": {
        "gold_path": "staged/product_months",
        "load": [
            {
                "step": "sql",
                "table": "product_months",
                "mode": "replace",
                "reads": ["fact_transactions", "dim_product"],
                "args": {"least": 0},
                "query": """
                    SELECT p.product_type, f.month_key, count(*) AS n, CAST(sum(f.amount) AS decimal(28,2)) AS total
                    FROM {fact_transactions} f JOIN {dim_product} p USING (sk_product)
                    WHERE f.resolved = 'true' AND f.amount >= :least AND p.product_type IN (SELECT product_type FROM {staged})
                    GROUP BY ALL
                """,
            }
        ],
    },
}


@query(
    "post_load_sql",
    FACT_SQL.replace("\nSELECT v.sk_customer", "\n, facts AS (SELECT l.product_type, v.sk_customer", 1)
    + """)
SELECT product_type, month_key, count(*) AS n, CAST(sum(amount) AS decimal(28,2)) AS total
FROM facts WHERE product_type IN (SELECT product_type FROM loaded WHERE batch = TIMESTAMP '2024-01-02')
GROUP BY product_type, month_key
""",
)
def _post_load_sql(spark, sf_dir):
    """A summary by SQL after each day's load; the second takes the place of the first."""
    lake = fresh_lake(spark)
    for day, raw in zip((FIRST_DAY, SECOND_DAY), deliveries(spark, sf_dir)):
        daily_load(spark, lake, CONTRACT, [CUSTOMER_PROCESS, PRODUCT_PROCESS], [FACT_PROCESS, SUMMARY_PROCESS], day, as_of=AS_OF, raw=raw)
    schema = T.StructType.fromDDL("product_type string, month_key int, n bigint, total decimal(28,2)")
    return read_appended(lake, "product_months", schema)
