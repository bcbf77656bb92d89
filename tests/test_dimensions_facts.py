from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from oreline.functions.text import row_hash
from oreline.operators.dimensions import (
    Scd2,
    date_dimension,
    insert_if_new,
    scd2_history,
    scd2_merge,
)
from oreline.operators.facts import lookup_as_of, not_loaded_yet
from oreline.plans.gold import scd2_schema
from oreline.session import as_nullable, materialize

SPEC = Scd2(keys=("k",), attributes=("v",), surrogate="sk")
DAY = datetime(2024, 1, 1)


def staged(spark, states, day):
    df = spark.createDataFrame([(k, v) for k, v in states.items()], "k string, v string")
    return df.withColumns(
        {
            "row_hash": row_hash(["v"]),
            "valid_from": F.lit(day.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )


def nothing(spark):
    schema = scd2_schema(staged(spark, {"x": "y"}, DAY).schema, SPEC)
    return spark.createDataFrame([], as_nullable(schema))


def load(spark, batches, spec=SPEC):
    """Daily merges, the way a job does them: closed rows leave the active set."""
    active, closed, last_key = nothing(spark), nothing(spark), 0
    for day, states in batches:
        after = materialize(scd2_merge(active, staged(spark, states, day), spec, last_key))
        active = after.where("is_active")
        closed = closed.unionByName(after.where("not is_active"))
        last_key = max([last_key, *[r["sk"] for r in after.select("sk").collect()]])
    return materialize(active.unionByName(closed).select(*spec.columns))


def brute(batches):
    """Sequential update and insert, in plain Python."""
    table, key = [], 0
    for day, states in batches:
        for k in sorted(states):
            current = next((r for r in table if r["k"] == k and r["active"]), None)
            if current and current["v"] == states[k]:
                continue
            if current:
                current.update(end=day - timedelta(seconds=1), active=False)
            key += 1
            table.append({"sk": key, "k": k, "v": states[k], "start": day, "end": None, "active": True})
    return sorted(((r["sk"], r["k"], r["v"], r["start"], r["end"], r["active"]) for r in table), key=repr)


def visible(df):
    return rows(df.select("sk", "k", "v", "valid_from", "valid_to", "is_active"))


def random_batches(seed, days=5):
    rng = random.Random(seed)
    return [
        (DAY + timedelta(days=d), {k: rng.choice("xyz") for k in "abcdefg" if rng.random() < 0.7})
        for d in range(days)
    ]


def test_daily_merges_equal_brute_force_and_the_rebuild(spark):
    batches = random_batches(3)
    merged = load(spark, batches)
    assert visible(merged) == brute(batches)
    everything = None
    for day, states in batches:
        one = staged(spark, states, day)
        everything = one if everything is None else everything.unionByName(one)
    assert visible(scd2_history(everything, SPEC)) == brute(batches)


def test_at_most_one_active_version_and_no_overlap(spark):
    merged = load(spark, random_batches(11))
    assert merged.where("is_active").groupBy("k").count().where("count > 1").isEmpty()
    a, b = merged.alias("a"), merged.alias("b")
    clash = a.join(b, F.expr("a.k = b.k and a.sk < b.sk and a.valid_from <= b.valid_to and b.valid_from <= a.valid_to"))
    assert clash.isEmpty()


def test_same_batch_twice_changes_nothing(spark):
    batches = random_batches(7, days=2)
    once = load(spark, batches)
    twice = load(spark, [*batches, batches[-1]])
    assert visible(once) == visible(twice)


def test_second_load_of_a_date_replaces_the_first(spark):
    batches = [(DAY, {"a": "x"}), (DAY + timedelta(days=1), {"a": "y"}), (DAY + timedelta(days=1), {"a": "z"})]
    versions = visible(load(spark, batches))
    assert [(v[0], v[2], v[5]) for v in versions] == [(1, "x", False), (2, "z", True)]
    assert all(v[4] is None or v[4] >= v[3] for v in versions)


def test_close_mode_for_the_same_date(spark):
    spec = replace(SPEC, same_date="close")
    versions = visible(load(spark, [(DAY, {"a": "x"}), (DAY, {"a": "y"})], spec))
    assert [(v[2], v[4], v[5]) for v in versions] == [
        ("x", DAY - timedelta(seconds=1), False), ("y", None, True),
    ]


def test_half_open_intervals(spark):
    spec = replace(SPEC, close="half_open")
    versions = visible(load(spark, [(DAY, {"a": "x"}), (DAY + timedelta(days=1), {"a": "y"})], spec))
    assert versions[0][4] == versions[1][3]
    with pytest.raises(ValueError):
        replace(SPEC, close="never")


@pytest.mark.parametrize("close", ["second", "half_open"])
@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_as_of_lookup_has_no_gap_between_versions(spark, close, limit):
    spec = replace(SPEC, close=close)
    dim = load(spark, [(DAY, {"a": "x"}), (DAY + timedelta(days=1), {"a": "y"})], spec)
    moments = [
        DAY - timedelta(seconds=1),
        DAY,
        DAY + timedelta(days=1) - timedelta(microseconds=1),
        DAY + timedelta(days=1),
        DAY + timedelta(days=90),
    ]
    facts = spark.createDataFrame([(i, "a", m) for i, m in enumerate(moments)], "id bigint, k string, ts timestamp_ntz")
    found = lookup_as_of(facts, dim, spec, "ts", "id", "left", limit).select("id", "sk")
    assert rows(found) == [(0, None), (1, 1), (2, 1), (3, 2), (4, 2)]


def test_insert_if_new_is_idempotent(spark):
    staged_rows = spark.createDataFrame([("b",), ("a",), ("b",)], "p string")
    none = spark.createDataFrame([], "sk bigint, p string")
    first = materialize(insert_if_new(none, staged_rows, ["p"], "sk"))
    assert rows(first.select("sk", "p")) == [(1, "a"), (2, "b")]
    assert insert_if_new(first, staged_rows, ["p"], "sk", 2).count() == 0
    more = spark.createDataFrame([("a",), ("c",)], "p string")
    assert rows(insert_if_new(first, more, ["p"], "sk", 2).select("sk", "p")) == [(3, "c")]


def test_date_dimension_skips_missing_dates(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 5),), (datetime(2024, 2, 29, 6),), (None,)], "t timestamp_ntz")
    row = date_dimension(df, "t").collect()
    assert [(r["sk_date"], r["weekday_name"], r["is_weekend"]) for r in row] == [(20240229, "Thursday", False)]


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_overlap_rows_are_not_loaded_twice(spark, limit):
    have = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, t int")
    come = [("a", 1)] * 20 + [("c", 3), ("b", 3), (None, 1), (None, 1)]
    come = spark.createDataFrame([(i, *r) for i, r in enumerate(come)], "id bigint, k string, t int")
    fresh = not_loaded_yet(come, have, ["k", "t"], "id", limit)
    assert rows(fresh.select("k", "t")) == sorted([("b", 3), ("c", 3), (None, 1), (None, 1)], key=repr)
