from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from oreline.operators.copies import without_copies
from oreline.operators.joins import plan_by_rows
from oreline.session import own_session

PARTS = [(1, "a"), (2, "b"), (3, "c"), (4, None)]
SEEN = [("a", 1, 0.0), ("a", 1, -0.0), ("a", 2, 1.0), ("b", 5, 1.0), ("b", 5, 1.0), (None, 7, 2.0)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    spark.createDataFrame(PARTS, "id int, kind string").write.parquet(f"{root}/parts")
    spark.createDataFrame(SEEN, "kind string, `n.n` int, x double").write.parquet(f"{root}/seen")
    return {n: spark.read.parquet(f"{root}/{n}") for n in ("parts", "seen")}


@pytest.mark.parametrize(
    "query, once",
    [
        ("SELECT id FROM {parts} WHERE kind IN (SELECT kind FROM {seen})", True),
        ("SELECT id FROM {parts} WHERE kind NOT IN (SELECT kind FROM {seen})", True),
        ("SELECT id FROM {parts} WHERE kind NOT IN (SELECT kind FROM {seen} WHERE `n.n` < 6)", True),
        ("SELECT id FROM {parts} p WHERE EXISTS (SELECT x FROM {seen} s WHERE s.kind = p.kind AND s.`n.n` > p.id)", True),
        ("SELECT id FROM {parts} p WHERE id = 3 OR EXISTS (SELECT 1 FROM {seen} s WHERE s.kind = p.kind)", True),
        ("WITH s AS (SELECT kind FROM {seen} UNION ALL SELECT 'c') SELECT id FROM {parts} WHERE kind IN (SELECT kind FROM s)", True),
        ("SELECT id FROM {parts} WHERE kind IN (SELECT s.kind FROM {seen} s JOIN {parts} p ON s.`n.n` = p.id)", True),
        ("SELECT id, s.kind FROM {parts} JOIN {seen} s USING (kind)", False),
        ("SELECT kind, count(*) AS n FROM {seen} WHERE kind IN (SELECT kind FROM {parts}) GROUP BY kind", False),
        ("SELECT id FROM {parts} WHERE id IN (SELECT count(*) FROM {seen} GROUP BY kind)", False),
        ("SELECT id FROM {parts} WHERE id = (SELECT count(*) FROM {seen} WHERE kind IS NULL)", False),
        ("SELECT id FROM {parts} WHERE kind IN (SELECT kind FROM {seen}) AND id < (SELECT count(*) FROM {seen})", False),
        ("SELECT id FROM {parts} WHERE kind IN (SELECT kind FROM {seen} ORDER BY `n.n` DESC, x LIMIT 3)", False),
        ("SELECT id FROM {parts} WHERE kind IN (SELECT first(kind) OVER (ORDER BY `n.n`) FROM {seen})", False),
        ("SELECT id FROM {parts} p WHERE EXISTS (SELECT 1 FROM {seen} s WHERE s.kind = p.kind AND s.x < p.id)", False),
        ("SELECT id FROM {parts} WHERE kind IN (SELECT kind FROM {seen} WHERE rand(1) < 0.5)", False),
        ("SELECT kind FROM {seen} UNION ALL SELECT kind FROM {parts} WHERE kind IN (SELECT kind FROM {seen})", False),
    ],
)
def test_copies_go_only_where_a_query_asks_for_rows(spark, stored, query, once):
    plain = spark.sql(query, **stored)
    kept = without_copies(plain, stored)
    assert (kept["seen"] is not stored["seen"]) == once
    assert kept["seen"].columns == stored["seen"].columns and kept["seen"].dtypes == stored["seen"].dtypes
    assert rows(spark.sql(query, **kept)) == rows(plain)
    if once:
        assert kept["seen"].count() < stored["seen"].count()


def test_small_files_of_many_values_are_not_broadcast(spark, stored, folder):
    spark.range(100_000).select((F.col("id") % 3).cast("string").alias("kind"), F.lit("x" * 40).alias("a.b")).write.parquet(folder + "/f")
    query = "SELECT id, count(s.kind) AS n FROM {parts} LEFT JOIN {s} s USING (kind) GROUP BY id"
    found = {}
    for limit in (1 << 20, 1 << 26):
        own = own_session(spark)
        frames = {"parts": own.read.parquet(*stored["parts"].inputFiles()), "s": own.read.parquet(folder + "/f")}
        plan_by_rows(own, frames.values(), limit)
        found[limit] = own.sql(query, **frames)
    assert ["BroadcastHashJoin" in plan(df) for df in found.values()] == [False, True]
    assert rows(found[1 << 20]) == rows(found[1 << 26])
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")


def test_a_session_of_its_own_knows_the_functions_and_settings(spark):
    spark.sql("CREATE TEMPORARY FUNCTION thrice(x INT) RETURNS INT RETURN x * 3")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        own = own_session(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == before
        own.conf.set("spark.sql.shuffle.partitions", "3")
        assert own.sql("SELECT thrice(2)").first()[0] == 6
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    finally:
        spark.sql("DROP TEMPORARY FUNCTION thrice")
