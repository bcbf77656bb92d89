from __future__ import annotations

import random
from datetime import datetime

import pytest
from conftest import DATA, plan, rows
from pyspark.sql import functions as F

from oreline.operators.constraints import foreign_key_audit, primary_key_audit
from oreline.operators.dedupe import dedupe_latest
from oreline.operators.joins import (
    fits_broadcast,
    hot_keys,
    lookup_join,
    measured_bytes,
    skew_safe_join,
)
from oreline.operators.keys import dense_keys, keys_by_position
from oreline.operators.layout import sorted_layout
from oreline.operators.ranking import latest, top_k_by_rank
from oreline.operators.transforms import (
    TransformContext,
    TransformError,
    apply_handler,
    apply_transforms,
    transform_names,
)
from oreline.suite.views import TX_SQL, tx


def test_transform_registry():
    assert transform_names() == sorted(
        ["select", "deduplicate", "add_hash", "add_execution_timestamp", "to_date",
         "add_date_key", "generate_date_parts", "watermark_filter", "cast", "rename"]
    )


@pytest.mark.parametrize(
    "steps, message",
    [
        ([{"type": "explode"}], "unknown transform 'explode'"),
        ([{"type": "select"}], "missing settings"),
        ([{"type": "add_execution_timestamp", "output_col": "t"}], "no execution time"),
    ],
)
def test_bad_lists_fail_before_anything_runs(spark, steps, message):
    with pytest.raises(TransformError, match=message):
        apply_transforms(spark.range(1), steps)


def test_unknown_handler(spark):
    with pytest.raises(TransformError, match="os.path"):
        apply_handler("os.path", spark.range(1), {}, TransformContext())


def test_watermark_reaches_the_scan(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    ctx = TransformContext(watermark=datetime(2024, 1, 15, 0, 0, 0, 5))
    steps = [{"type": "watermark_filter", "column": "ts"}, {"type": "select", "columns": ["ts"]}]
    text = plan(apply_transforms(events, steps, ctx))
    assert "GreaterThan(ts,2024-01-15T00:00:00.000005)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    assert apply_transforms(events, steps[:1], TransformContext()).count() == events.count()


def test_date_names_do_not_depend_on_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 9, 23, 30),)], "t timestamp_ntz")
    step = {"type": "generate_date_parts", "from_column": "t"}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        row = apply_transforms(df, [step]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["anio"], row["mes"], row["dia"], row["trimestre"]) == (2024, 3, 9, 1)
    assert (row["nombre_mes"], row["dia_semana"], row["es_fin_de_semana"]) == ("March", "Saturday", True)


def test_dedupe_is_total_and_combines_before_the_shuffle(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 1, "m"), ("b", None, "q")]
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(4)
    best = dedupe_latest(df, ["k"], ["t"])
    assert rows(best) == sorted([("a", 2, "z"), (None, 1, "n"), ("b", None, "q")], key=repr)
    assert best.columns == ["k", "t", "v"]
    text = plan(best)
    assert text.count("Exchange hashpartitioning(k") == 1 and "partial_max" in text


def skewed(spark, n=6000):
    """A third of the rows have one key and are copies of each other but for the id."""
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 400).cast("bigint").alias("k"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_safe_join_equals_plain_join(spark, how):
    large = skewed(spark)
    lookup = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([(7, 70)], "k bigint, v bigint"))
    expected = rows(large.join(lookup, "k", how).select("row_id", "k", "v"))
    assert rows(skew_safe_join(large, lookup, ["k"], "row_id", how)) == expected
    assert rows(lookup_join(large, lookup, ["k"], "row_id", how)) == expected
    assert rows(lookup_join(large, lookup, ["k"], "row_id", how, broadcast_bytes=0)) == expected


def test_hot_keys_are_few_and_well_cut(spark):
    hot = hot_keys(skewed(spark), ["k"]).collect()
    assert [r["k"] for r in hot] == [7]
    assert hot[0]["_slices"] == 3  # a third of the rows, eight partitions


def test_no_slice_is_hot(spark):
    """Adaptive execution is off, so the partitions are those of the join's exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        large = skewed(spark, 32000)
        lookup = spark.range(400).select(F.col("id").alias("k"), F.col("id").alias("v"))

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(large.join(lookup, "k"))
        cut = largest(skew_safe_join(large, lookup, ["k"], "row_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert plain > 10000  # the hot key
    assert cut < 6000


def test_join_condition_is_a_residual_of_the_equi_join(spark):
    large, lookup = skewed(spark), spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 5).alias("v"))
    joined = lookup_join(large, lookup, ["k"], "row_id", condition=large["row_id"] > lookup["v"])
    assert joined.where("row_id <= v").count() == 0
    assert "BroadcastHashJoin" in plan(joined) and "NestedLoop" not in plan(joined)


def test_broadcast_is_measured(spark):
    df = spark.range(1000).select("id", F.lpad(F.col("id").cast("string"), 100, "x").alias("s"))
    assert measured_bytes(df) == 1000 * (8 + 16 + 100)
    assert fits_broadcast(df, 200_000) and not fits_broadcast(df, 100_000)
    assert measured_bytes(df.where("id < 0")) == 0


def test_dense_keys_equal_a_global_row_number(spark):
    customers = spark.read.parquet(f"{DATA}/customer.parquet").select("c_custkey", "c_name")
    numbered = dense_keys(customers, "sk", ["c_name"], start=40)
    names = [r["c_name"] for r in customers.orderBy("c_name").collect()]
    found = [(r["sk"], r["c_name"]) for r in numbered.orderBy("sk").collect()]
    assert found == [(41 + i, n) for i, n in enumerate(names)]
    assert dense_keys(customers.where("1 = 0"), "sk", ["c_name"]).count() == 0


def test_position_keys_survive_many_files_and_repeated_reads(spark, folder):
    df = spark.range(5000).withColumn("v", F.col("id") % 3)
    df.repartition(13).write.option("maxRecordsPerFile", 100).parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    keyed = keys_by_position(stored, "sk", 10)
    assert sorted(r["sk"] for r in keyed.select("sk").collect()) == list(range(11, 5011))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = keys_by_position(spark.read.parquet(f"{folder}/t"), "sk", 10)
        assert rows(again) == rows(keyed)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")


def brute_rank(values, k):
    known = [v for v in values if v is not None]
    rank = {v: 1 + sum(w > v for w in known) for v in known}
    rank[None] = len(known) + 1
    return sorted(((rank[v], v) for v in values if rank[v] <= k), key=repr)


@pytest.mark.parametrize(
    "values",
    [
        [5, 3, 3, 3, 1],
        [7] * 50 + [1, 2, 3],  # everything ties at the top
        [1, 2, None, None],
        [None, None],
        [],
        list(range(30)),
    ],
)
def test_top_k_by_rank(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "score int")
    assert rows(top_k_by_rank(df, "score", 3)) == brute_rank(values, 3)


def test_rank_window_sees_only_distinct_winning_scores(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(1000)], "score int")
    text = plan(top_k_by_rank(df, "score", 3))
    below = text[text.index("Window"):].splitlines()[:6]
    assert any("Exchange SinglePartition" in line for line in below)
    assert any("HashAggregate(keys=[score" in line for line in below)


def test_latest(spark):
    df = spark.range(100).withColumn("t", F.col("id") % 10)
    assert [r["id"] for r in latest(df, "t", 3, "id").collect()] == [9, 19, 29]
    assert "TakeOrderedAndProject" in plan(latest(df, "t", 3, "id"))


def test_audits_on_clean_and_empty_frames(spark):
    empty = spark.createDataFrame([], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert foreign_key_audit(empty, "k", parent, "k").first()["violations"] == 0
    assert primary_key_audit(empty, ["k"]).first()["violations"] == 0
    hot = spark.range(1000).select(F.lit(2).alias("k"))
    assert foreign_key_audit(hot, "k", parent, "k").first()["violations"] == 1000
    nulls = spark.createDataFrame([(None,)], "k int")
    assert foreign_key_audit(nulls, "k", parent, "k").first()["violations"] == 0


def test_random_dedupe_against_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.randrange(5), rng.randrange(4), rng.choice("abc")) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, t int, v string")
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (-1, "")), (t, v))
    assert rows(dedupe_latest(df, ["k"], ["t"])) == sorted(
        ((k, t, v) for k, (t, v) in best.items()), key=repr
    )


def test_hot_folder_is_cut_and_its_files_are_sorted(spark, folder):
    """A third of the rows share a month; no task may get them all."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        df = spark.range(0, 60000, 1, 24).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("month"),
            F.xxhash64("id").alias("t"),
        )
        sorted_layout(df, ["month"], ["t"]).write.partitionBy("month").parquet(f"{folder}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    stored = spark.read.parquet(f"{folder}/t").select(
        "month", "t", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")
    )
    per_file = stored.where("month = 7").groupBy("f").count()
    assert per_file.count() >= 3 and per_file.agg(F.max("count")).first()[0] < 15000
    a, b = stored.alias("a"), stored.alias("b")
    assert a.join(b, F.expr("a.month = b.month and a.f = b.f and a.i + 1 = b.i and a.t > b.t")).isEmpty()
    assert stored.count() == 60000


def test_top_k_rejects_k_below_one(spark):
    with pytest.raises(ValueError):
        top_k_by_rank(spark.range(3), "id", 0)


def test_transactions_join_customers_to_orders_before_lines(spark, folder):
    """Lines are shuffled without a customer's columns; null and repeated keys give the rows of the SQL."""
    day = datetime(1998, 5, 1)
    tables = {
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
                     [(1, 1, 7, 5.0, "A", day), (1, 2, 8, 6.0, "N", day), (2, 1, 7, 7.0, None, day), (None, 1, 7, 8.0, "R", day), (1, 3, None, 9.0, "R", day), (9, 1, 7, 1.0, "A", day)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(1, 3), (1, 3), (2, 4), (None, 3), (9, None)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(3, "c", 0, -2.5, "BUILDING"), (4, None, 1, 1.0, None), (4, "d", 1, None, "AUTOMOBILE"), (None, "n", 0, 1.0, "x")]),
        "nation": ("n_nationkey int, n_name string", [(0, "N0"), (1, "N1"), (1, "N2")]),
        "part": ("p_partkey bigint, p_type string", [(7, "LARGE"), (7, None), (8, "SMALL"), (None, "x")]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        got = tx(spark, folder)
        text = plan(got)
        expected = rows(spark.sql(TX_SQL))
    finally:
        spark.conf.set(limit, before)
        for name in tables:
            spark.catalog.dropTempView(name)
    assert rows(got) == expected and len(expected) == 14
    joins = [text.index(f"SortMergeJoin [{key}") for key in ("l_orderkey", "l_partkey", "o_custkey")]
    assert joins == sorted(joins)  # the last join is the only one that meets lines and customers
