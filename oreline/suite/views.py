"""Transaction-shaped views of the driver tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TX_SQL = """
SELECT
  substr(c_mktsegment, 1, 2) AS id_type,
  c_custkey AS id_number,
  concat(CAST(l_orderkey AS varchar(20)), '-', CAST(l_linenumber AS varchar(20))) AS account_no,
  c_name AS full_name,
  CASE l_returnflag WHEN 'A' THEN 'PURCHASE' WHEN 'N' THEN 'DEPOSIT' ELSE 'WITHDRAWAL' END AS tx_type,
  CAST(l_extendedprice AS decimal(18,2)) AS amount,
  p_type AS product_type,
  n_name AS city,
  l_shipdate AS event_ts,
  CASE WHEN c_custkey % 7 = 0 THEN NULL
       ELSE date '1915-01-01' + CAST(c_custkey % 20000 AS int) * 10 END AS birth_date,
  c_acctbal < 0 AS risk_flag,
  CASE WHEN c_acctbal < 0 THEN CAST(-c_acctbal AS decimal(18,2)) END AS risk_amount,
  CASE WHEN c_acctbal < 0 THEN CAST(c_custkey % 90 AS int) END AS overdue_days
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN part     ON l_partkey = p_partkey
"""

TX_COLUMNS = (
    "id_type", "id_number", "account_no", "full_name", "tx_type", "amount",
    "product_type", "city", "event_ts", "birth_date", "risk_flag", "risk_amount",
    "overdue_days",
)

# The same transactions as a source would deliver them: text, with faults.
RAW_SQL = f"""
SELECT
  id_type,
  CAST(id_number AS varchar(20)) AS id_number,
  CASE WHEN id_number % 53 = 0 AND overdue_days IS NULL THEN NULL ELSE account_no END AS account_no,
  full_name,
  tx_type,
  CASE WHEN account_no LIKE '%99-%' THEN 'n/a'
       WHEN account_no LIKE '%98-%' THEN '-' || CAST(amount AS varchar(30))
       ELSE CAST(amount AS varchar(30)) END AS amount,
  product_type,
  CASE WHEN city = 'NATION_3' AND id_number % 2 = 0 THEN 'NATI0N_3' ELSE city END AS city,
  CAST(event_ts AS varchar(30)) AS event_ts,
  CASE WHEN id_number % 41 = 0 THEN '1990-13-45'
       ELSE CAST(birth_date AS varchar(20)) || ' 00:00:00' END AS birth_date,
  CAST(risk_flag AS varchar(10)) AS risk_flag,
  CAST(risk_amount AS varchar(30)) AS risk_amount,
  CAST(overdue_days AS varchar(10)) AS overdue_days
FROM tx
"""


def with_tx(body: str) -> str:
    """SQL over a ``tx`` common table expression."""
    return f"WITH tx AS ({TX_SQL})\n{body}"


def with_raw(body: str) -> str:
    return f"WITH tx AS ({TX_SQL}), raw AS ({RAW_SQL})\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joins of ``TX_SQL`` in an order that keeps shuffled lines narrow.

    Customers meet their orders, of which there are far fewer than lines; lines meet their part before they meet
    either, so no shuffle of lines carries a customer's columns.
    """
    lineitem, orders, customer, nation, part = (
        table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "part")
    )
    settled = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    bought = orders.join(settled, orders["o_custkey"] == customer["c_custkey"])
    sold = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
    joined = sold.join(bought, lineitem["l_orderkey"] == orders["o_orderkey"])
    return spark.sql(TX_SQL.partition("FROM lineitem")[0] + "FROM {joined}", joined=joined)


def raw_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_SQL.replace("FROM tx", "FROM {tx}"), tx=tx(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


