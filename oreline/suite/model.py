"""The transaction model the queries run on: contract, processes and star."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.contract import contract_from_dict
from oreline.functions.dates import date_key
from oreline.functions.literals import instant
from oreline.functions.text import row_hash
from oreline.operators.dedupe import dedupe_latest
from oreline.operators.dimensions import Scd2, date_dimension, insert_if_new, scd2_merge
from oreline.operators.facts import lookup_active, lookup_key
from oreline.operators.keys import keys_by_position
from oreline.operators.layout import sorted_layout
from oreline.plans.analytics import Star
from oreline.plans.gold import scd2_schema
from oreline.session import as_nullable, materialize, scratch_path
from oreline.suite.views import tx

AS_OF = datetime(2010, 1, 1)
LOAD_TIME = datetime(2024, 1, 1)

CONTRACT = contract_from_dict(
    {
        "source_name": "transactions",
        "version": "1.0.0",
        "file_format": "csv",
        "delimiter": ",",
        "encoding": "utf-8",
        "partition_keys": ["year", "month", "day"],
        "primary_key": ["account_no", "event_ts"],
        "column_renames": {
            "id type": "id_type",
            "número id": "id_number",
            "account no": "account_no",
            "transaction type": "tx_type",
            "date-time": "event_ts",
        },
        "columns": [
            {"name": "id_type", "spark_type": "StringType", "nullable": False,
             # Market segments of the driver's customers, by their first letters; MACHINERY is not served.
             "valid_values": ["AU", "BU", "FU", "HO"]},
            {"name": "id_number", "spark_type": "LongType", "nullable": False},
            {"name": "account_no", "spark_type": "StringType", "nullable": False},
            {"name": "full_name", "spark_type": "StringType", "nullable": False},
            {"name": "tx_type", "spark_type": "StringType", "nullable": False,
             "valid_values": ["PURCHASE", "DEPOSIT", "WITHDRAWAL"]},
            {"name": "amount", "spark_type": "DecimalType", "nullable": False,
             "precision": 18, "scale": 2, "min_value": 0},
            {"name": "product_type", "spark_type": "StringType", "nullable": False},
            {"name": "city", "spark_type": "StringType", "nullable": False},
            {"name": "event_ts", "spark_type": "TimestampType", "nullable": False},
            {"name": "birth_date", "spark_type": "TimestampType", "nullable": True},
            {"name": "risk_flag", "spark_type": "BooleanType", "nullable": False},
            {"name": "risk_amount", "spark_type": "DecimalType", "nullable": True,
             "precision": 18, "scale": 2, "min_value": 0},
            {"name": "overdue_days", "spark_type": "IntegerType", "nullable": True},
        ],
        "normalizations": {"city": {"NATI0N_3": "NATION_3"}},
        "quality_rules": {
            # The generated birth dates tie the valid rate to the scale factor (10 % at
            # sf0.001, 67 % at sf0.01, 25 % at sf0.1), so no single gate fits them.
            # The gate has a query of its own, with a fixed rate, and its own tests.
            "min_valid_rate": 0.0,
            "reject_on_null_pk": True,
            "reject_date_before": "1920-01-01",
            "reject_future_dates": True,
            "date_columns": ["birth_date"],
        },
    }
)

CUSTOMER_KEYS = ("id_type", "id_number")
CUSTOMER_ATTRIBUTES = (
    "full_name", "city", "birth_date", "risk_flag", "risk_amount", "overdue_days",
)
CUSTOMER = Scd2(keys=CUSTOMER_KEYS, attributes=CUSTOMER_ATTRIBUTES)


def process(name: str, steps: list[dict], load: dict, watermark: dict | None = None) -> dict:
    """A process document over the transactions; the words of its keys are fixed values of the format."""
    document = {
        "process_type": name,
        "source": {"source_name": CONTRACT.source_name},
        "transformations": steps,
        "target": {"gold_path": f"staged/{name}", "load": [{"table": name, **load}]},
    }
    return document | ({"watermark": watermark} if watermark else {})


def versioned(name: str, spec: Scd2, latest_by: str, dates: tuple[str, ...]) -> dict:
    """Keeps versions of an entity that the transactions describe: its latest row of the batch, hashed."""
    columns = [*spec.keys, *spec.attributes]
    return process(
        name,
        [
            {"type": "add_execution_timestamp", "output_col": spec.start},
            {"type": "deduplicate", "keys": [*spec.keys], "order_by": [latest_by, *spec.attributes]},
            *[{"type": "to_date", "column": c} for c in dates],
            {"type": "add_hash", "columns": [*spec.attributes], "output_col": spec.hash},
            {"type": "select", "columns": [*columns, spec.hash, spec.start]},
        ],
        {"step": "scd2", "keys": [*spec.keys], "attributes": [*spec.attributes], "surrogate": spec.surrogate},
    )


#: One row per day before its parts are worked out.
DATE_STEPS = [
    {"type": "rename", "from": "event_ts", "to": "date"},
    {"type": "to_date", "column": "date"},
    {"type": "select", "columns": ["date"]},
    {"type": "deduplicate", "keys": ["date"]},
    {"type": "add_date_key", "from_column": "date", "output_col": "sk_date"},
    {"type": "generate_date_parts", "from_column": "date", "naming": "en"},
]
FACT_MEASURES = ["account_no", "tx_type", "amount", "event_ts"]

CUSTOMER_PROCESS = versioned("dim_customer", CUSTOMER, "event_ts", ("birth_date",))
PRODUCT_PROCESS = process(
    "dim_product",
    [{"type": "select", "columns": ["product_type"]}],
    {"step": "insert_new", "key": ["product_type"], "surrogate": "sk_product"},
)
DATE_PROCESS = process("dim_date", DATE_STEPS, {"step": "insert_new", "key": ["sk_date"]})
FACT_PROCESS = process(
    "fact_transactions",
    [
        {"type": "watermark_filter", "column": "event_ts"},
        {"type": "select", "columns": [*FACT_MEASURES, "product_type", *CUSTOMER_KEYS]},
    ],
    {
        "step": "fact",
        "surrogate": "sk_transaction",
        "key": ["account_no", "event_ts"],
        "event_time": "event_ts",
        "date_key": "sk_date",
        "measures": FACT_MEASURES,
        "lookups": [
            {"table": "dim_product", "keys": ["product_type"], "surrogate": "sk_product"},
            {"table": "dim_customer", "keys": [*CUSTOMER_KEYS], "surrogate": "sk_customer", "versioned": True},
        ],
    },
    {"source_name": CONTRACT.source_name, "timestamp_column": "event_ts", "apply_filter": True,
     "update_after_load": True, "seed": "1900-01-01"},
)

DIMENSIONS = [CUSTOMER_PROCESS, PRODUCT_PROCESS, DATE_PROCESS]
FACTS = [FACT_PROCESS]


def staged_customers(source: DataFrame, load_time: datetime = LOAD_TIME) -> DataFrame:
    """One row per customer, as of its latest transaction."""
    wanted = source.select(*CUSTOMER_KEYS, *CUSTOMER_ATTRIBUTES, "event_ts")
    return (
        dedupe_latest(wanted, CUSTOMER_KEYS, ["event_ts"])
        .withColumns({"row_hash": row_hash(CUSTOMER_ATTRIBUTES), "valid_from": instant(load_time)})
        .select(*CUSTOMER.staged_columns)
    )


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], as_nullable(schema))


def build_star(spark: SparkSession, source: DataFrame) -> Star:
    """Load an empty star from one batch of transactions."""
    silver = materialize(source, "transactions")
    date = materialize(date_dimension(silver, "event_ts"), "dim-date")

    product_types = silver.select("product_type")
    product = materialize(
        insert_if_new(
            no_rows(spark, product_types.schema), product_types, ["product_type"], "sk_product"
        ),
        "dim-product",
    )
    staged = staged_customers(silver)
    nobody = no_rows(spark, scd2_schema(staged.schema, CUSTOMER))
    customer = materialize(scd2_merge(nobody, staged, CUSTOMER), "dim-customer")

    numbered = keys_by_position(
        silver.select(*CUSTOMER_KEYS, "product_type", *FACT_MEASURES), "sk_transaction"
    )
    keyed = lookup_key(
        lookup_active(numbered, customer, CUSTOMER, "sk_transaction"),
        product,
        ["product_type"],
        "sk_product",
        "sk_transaction",
    )
    day = F.col("event_ts")
    fact = keyed.select(
        "sk_transaction", "sk_customer", "sk_product", date_key(day).alias("sk_date"),
        *FACT_MEASURES, (F.year(day) * 100 + F.month(day)).alias("month_key"),
    )
    path = scratch_path(spark, "fact")
    sorted_layout(fact, ["month_key"], ["sk_date", "event_ts"]).write.partitionBy(
        "month_key"
    ).parquet(path)
    schema = T.StructType(
        [f for f in fact.schema.fields if f.name != "month_key"] + [fact.schema["month_key"]]
    )
    return Star(spark.read.schema(as_nullable(schema)).parquet(path), customer, product, date)


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The loaded star, as a warehouse has it: built once, then queried."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = build_star(spark, tx(spark, sf_dir))
    return _stars[key]
