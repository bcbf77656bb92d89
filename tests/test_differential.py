"""Every registered query against its SQL in another engine."""

from __future__ import annotations

import duckdb
import pytest
from conftest import DATA

from oreline.suite import ORACLES, QUERIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, engine, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    wanted = {r[0]: r[1] for r in engine.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: TYPES.get(k, k.upper()) for c, k in kinds.items()} == wanted
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = engine.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()
    actual = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    import __spark_entry__ as driver

    flagship = driver.entry(spark)
    assert flagship.count() > 0
    assert flagship.columns == QUERIES["profitability_ranking"](spark, DATA).columns
    assert QUERIES.items() <= driver.queries().items() and ORACLES.items() <= driver.oracle_sql().items()
    assert set(driver.oracle_sql()) <= set(driver.queries())
