"""Star-schema analytics."""

from __future__ import annotations

from oreline.plans.analytics import (
    profitability_by_natural_key,
    profitability_ranking,
    star_rollup,
)
from oreline.suite.model import star
from oreline.suite.registry import query
from oreline.suite.views import with_tx

YEAR = 1998

# Averages are decimals rounded half up, twice; integer arithmetic gives them exactly.
RANKING_SQL = with_tx(
    f"""
, volumes AS (
  SELECT id_type, id_number, product_type,
         count(*) AS n,
         CAST(sum(amount) * 100 AS hugeint) AS cents
  FROM tx WHERE extract(year FROM event_ts) = {YEAR}
  GROUP BY ALL
), customers AS (
  SELECT DISTINCT id_type, id_number, full_name, city, risk_flag, risk_amount FROM tx
), metrics AS (
  SELECT id_type, id_number,
         count(*) AS num_products,
         CAST(sum(n) AS bigint) AS total_transactions,
         CAST(sum(cents) AS hugeint) AS cents,
         CAST(sum((2 * cents * 10000 + n) // (2 * n)) AS hugeint) AS e6
  FROM volumes GROUP BY ALL
), scored AS (
  SELECT *, CASE WHEN risk_flag THEN cents * 7 ELSE cents * 10 END AS mills
  FROM metrics JOIN customers USING (id_type, id_number)
), ranked AS (
  SELECT *, rank() OVER (ORDER BY mills DESC) AS ranking FROM scored
)
SELECT ranking, id_type, id_number, full_name, city, num_products, total_transactions,
       CAST(CAST(cents AS decimal(36,0)) * CAST(0.01 AS decimal(2,2)) AS decimal(38,2)) AS total_amount,
       CAST(CAST((2 * e6 * 10000 + num_products) // (2 * num_products) AS decimal(26,0))
            * CAST(0.0000000001 AS decimal(10,10)) AS decimal(26,10)) AS average_ticket,
       CAST(CAST(mills AS decimal(35,0)) * CAST(0.001 AS decimal(3,3)) AS decimal(38,3)) AS score,
       risk_flag, risk_amount
FROM ranked WHERE ranking <= 100
"""
)


@query("profitability_ranking", RANKING_SQL)
def _ranking(spark, sf_dir):
    return profitability_ranking(star(spark, sf_dir), YEAR)


@query("profitability_natural_key", RANKING_SQL)
def _natural_key(spark, sf_dir):
    return profitability_by_natural_key(star(spark, sf_dir), YEAR)


@query(
    "star_join_rollup",
    with_tx(
        """
SELECT CAST(extract(year FROM event_ts) AS smallint) AS year, city, product_type,
       count(*) AS num_transactions, CAST(sum(amount) AS decimal(38,2)) AS total_amount
FROM tx GROUP BY ALL
"""
    ),
)
def _rollup(spark, sf_dir):
    return star_rollup(star(spark, sf_dir))
