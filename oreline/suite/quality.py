"""Validation rules, the three-way split and the constraint audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreline.operators.clean import contract_cast, normalize_values
from oreline.operators.constraints import (
    constraint_audit,
    foreign_key_audit,
    null_and_length_audit,
    primary_key_audit,
)
from oreline.operators.quality import (
    OUTCOME,
    REASONS,
    flag_rows,
    gate_frame,
    metrics_frame,
    row_rules,
    rule_breakdown,
)
from oreline.suite.model import AS_OF, CONTRACT
from oreline.suite.registry import query
from oreline.suite.transforms import TYPED_SQL, typed_tx
from oreline.suite.views import raw_tx, table, tx, with_raw, with_tx

KEYS = ["account_no", "event_ts", "id_number", "amount"]


def with_typed(body: str) -> str:
    return with_raw(f", typed AS ({TYPED_SQL})\n{body}")


def _rule(spark, sf_dir, name, policy="strict"):
    rule = row_rules(CONTRACT, AS_OF, policy)[name]
    return typed_tx(spark, sf_dir).select(*KEYS, rule.alias("passed"))


def _rule_sql(test: str) -> str:
    return with_typed(f"SELECT {', '.join(KEYS)}, {test} AS passed FROM typed")


@query("q_pk_not_null", _rule_sql("account_no IS NOT NULL AND event_ts IS NOT NULL"))
def _pk(spark, sf_dir):
    return _rule(spark, sf_dir, "pk_not_null")


@query("q_allowed_values", _rule_sql("id_type IN ('AU', 'BU', 'FU', 'HO')"))
def _allowed(spark, sf_dir):
    return _rule(spark, sf_dir, "allowed:id_type")


@query("q_min_value", _rule_sql("risk_amount >= 0"))
def _min_value(spark, sf_dir):
    """Under the SQL policy a missing amount leaves the rule undecided."""
    return _rule(spark, sf_dir, "min:risk_amount", "sql")


@query("q_date_floor", _rule_sql("birth_date IS NULL OR birth_date >= TIMESTAMP '1920-01-01'"))
def _floor(spark, sf_dir):
    return _rule(spark, sf_dir, "date_floor:birth_date")


@query("q_no_future", _rule_sql("birth_date IS NULL OR birth_date <= TIMESTAMP '2010-01-01'"))
def _no_future(spark, sf_dir):
    return _rule(spark, sf_dir, "no_future:birth_date")


# The rules a row fails, in the order the rules are listed.
STRICT_SQL = """
, judged AS (
  SELECT *, concat_ws(',',
    CASE WHEN account_no IS NULL THEN 'pk_not_null' END,
    CASE WHEN account_no IS NULL THEN 'not_null:account_no' END,
    CASE WHEN amount IS NULL THEN 'not_null:amount' END,
    CASE WHEN raw_amount IS NOT NULL AND amount IS NULL THEN 'cast_failed:amount' END,
    CASE WHEN raw_birth_date IS NOT NULL AND birth_date IS NULL THEN 'cast_failed:birth_date' END,
    CASE WHEN id_type NOT IN ('AU', 'BU', 'FU', 'HO') THEN 'allowed:id_type' END,
    CASE WHEN amount < 0 THEN 'min:amount' END,
    CASE WHEN birth_date < TIMESTAMP '1920-01-01' THEN 'date_floor:birth_date' END,
    CASE WHEN birth_date > TIMESTAMP '2010-01-01' THEN 'no_future:birth_date' END
  ) AS reasons
  FROM typed
), outcomes AS (
  SELECT *, CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS outcome FROM judged
)
"""

# The typed rows next to the raw text of the columns that may fail to parse.
STRICT_TYPED_SQL = TYPED_SQL.replace(
    "FROM raw", ", amount AS raw_amount, birth_date AS raw_birth_date, city AS raw_city,"
    " id_number AS raw_id_number FROM raw"
).replace("overdue_days\n,", "overdue_days,")


def with_outcomes(body: str) -> str:
    return with_raw(f", typed AS ({STRICT_TYPED_SQL}) {STRICT_SQL}\n{body}")


def strict_rows(spark, sf_dir):
    clean = normalize_values(raw_tx(spark, sf_dir), CONTRACT.normalizations)
    typed = contract_cast(clean, CONTRACT, keep_raw=True)
    return flag_rows(typed, row_rules(CONTRACT, AS_OF, with_cast_failures=True))


def _judged_columns(flagged):
    return flagged.select(
        *KEYS, F.col(OUTCOME).alias("outcome"), F.concat_ws(",", REASONS).alias("reasons")
    )


@query("q_split_strict", with_outcomes(f"SELECT {', '.join(KEYS)}, outcome, reasons FROM outcomes"))
def _split_strict(spark, sf_dir):
    return _judged_columns(strict_rows(spark, sf_dir))


SQL_POLICY_SQL = """
, judged AS (
  SELECT *, (id_type IN ('AU', 'BU', 'FU', 'HO')) AND amount >= 0 AND risk_amount >= 0
        AND (birth_date IS NULL OR birth_date >= TIMESTAMP '1920-01-01')
        AND (birth_date IS NULL OR birth_date <= TIMESTAMP '2010-01-01') AS flag
  FROM tx
)
SELECT account_no, event_ts, id_number, amount,
       CASE WHEN flag THEN 'valid' WHEN NOT flag THEN 'rejected' ELSE 'indeterminate' END AS outcome,
       concat_ws(',',
         CASE WHEN id_type NOT IN ('AU', 'BU', 'FU', 'HO') THEN 'allowed:id_type' END,
         CASE WHEN risk_amount IS NULL THEN 'min:risk_amount?' END,
         CASE WHEN birth_date < TIMESTAMP '1920-01-01' THEN 'date_floor:birth_date' END,
         CASE WHEN birth_date > TIMESTAMP '2010-01-01' THEN 'no_future:birth_date' END) AS reasons
FROM judged
"""


@query("q_split_sql", with_tx(SQL_POLICY_SQL))
def _split_sql(spark, sf_dir):
    rules = row_rules(CONTRACT, AS_OF, "sql")
    return _judged_columns(flag_rows(tx(spark, sf_dir), rules))


_METRICS_SQL = """
SELECT count(*) AS rows_read,
       count(*) FILTER (outcome = 'valid') AS rows_valid,
       count(*) FILTER (outcome = 'rejected') AS rows_rejected,
       count(*) FILTER (outcome = 'indeterminate') AS rows_indeterminate
FROM outcomes
"""


@query("q_metrics", with_outcomes(_METRICS_SQL))
def _metrics(spark, sf_dir):
    return metrics_frame(strict_rows(spark, sf_dir))


@query(
    "q_gate",
    with_outcomes(
        f"""
SELECT *, rows_valid / rows_read AS valid_rate, rows_valid / rows_read >= 0.6 AS gate_passed
FROM ({_METRICS_SQL})
"""
    ),
)
def _gate(spark, sf_dir):
    return gate_frame(metrics_frame(strict_rows(spark, sf_dir)), 0.6)


@query(
    "q_reasons",
    with_outcomes(
        """
SELECT reason, count(*) AS n_rows
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM outcomes WHERE reasons <> '')
GROUP BY reason
"""
    ),
)
def _reasons(spark, sf_dir):
    return rule_breakdown(strict_rows(spark, sf_dir))


@query(
    "constraint_audit",
    with_tx(
        """
SELECT 'not_null:account_no' AS constraint_name, count(*) FILTER (account_no IS NULL) AS violations FROM tx
UNION ALL SELECT 'not_null:overdue_days', count(*) FILTER (overdue_days IS NULL) FROM tx
UNION ALL SELECT 'max_length:product_type', count(*) FILTER (length(product_type) > 5) FROM tx
UNION ALL SELECT 'max_length:id_type', count(*) FILTER (length(id_type) > 10) FROM tx
UNION ALL SELECT 'primary_key:account_no,event_ts',
       (SELECT CAST(coalesce(sum(n - 1), 0) AS bigint) FROM
          (SELECT count(*) AS n FROM tx GROUP BY account_no, event_ts))
UNION ALL SELECT 'foreign_key:l_suppkey',
       (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN
          (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
UNION ALL SELECT 'foreign_key:l_partkey',
       (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
"""
    ),
)
def _audit(spark, sf_dir):
    rows = tx(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    solvent = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    return constraint_audit(
        null_and_length_audit(
            rows, ["account_no", "overdue_days"], {"product_type": 5, "id_type": 10}
        ),
        primary_key_audit(rows, ["account_no", "event_ts"]),
        foreign_key_audit(lines, "l_suppkey", solvent, "s_suppkey"),
        foreign_key_audit(lines, "l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
    )
