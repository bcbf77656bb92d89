from __future__ import annotations

import copy
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.ledger import FAILED, ConcurrentLoad
from oreline.operators.quality import QualityGateError
from oreline.operators.transforms import handler
from oreline.plans.daily import daily_load
from oreline.plans.gold import (
    ConfigError,
    StaleBatch,
    gold_job,
    insert_schema,
    read_fact,
    read_orphans,
    replay_orphans,
)
from oreline.plans.lake import Lake, NotLoaded, read_appended, read_rejects, read_silver
from oreline.plans.silver import silver_job
from oreline.session import scratch_path
from oreline.sources.writers import land_raw
from oreline.streaming.ingest import stream_daily, stream_silver
from oreline.suite.jobs import as_delivered, customer_versions
from oreline.suite.model import CONTRACT, CUSTOMER_PROCESS, DIMENSIONS, FACT_PROCESS, FACTS

AS_OF = datetime(2010, 1, 1)
DAY = date(2024, 1, 1)
NEXT = date(2024, 1, 2)
COLUMNS = CONTRACT.schema.names


def line(id_number, account, city="TOWN", amount="10.00", at="1998-05-01 10:00:00", id_type="AU",
         product="LOAN"):
    return (id_type, id_number, account, f"Name {id_number}", "PURCHASE", amount, product, city,
            at, None, "false", None, None)


def raw(spark, lines):
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return as_delivered(spark.createDataFrame(lines, schema))


@pytest.fixture()
def lake(spark):
    return Lake(spark, scratch_path(spark, "lake"))


def day(spark, lake, lines, when, **options):
    return daily_load(spark, lake, CONTRACT, DIMENSIONS, FACTS, when, as_of=AS_OF, raw=raw(spark, lines), **options)


def facts(lake):
    rows_ = read_fact(lake, FACT_PROCESS, CONTRACT.schema)
    return rows(rows_.select("account_no", "sk_customer", "sk_transaction"))


def test_failed_gate_leaves_rejects_and_counts_but_publishes_nothing(spark, lake):
    strict = replace(CONTRACT, quality_rules=replace(CONTRACT.quality_rules, min_valid_rate=0.9))
    lines = [line("1", "a"), line("2", "b", amount="junk"), line("x", None)]
    with pytest.raises(QualityGateError):
        silver_job(spark, lake, strict, DAY, as_of=AS_OF, raw=raw(spark, lines))
    state = lake.ledger.state().first()
    assert (state["status"], state["rows_read"], state["rows_valid"], state["rows_rejected"]) == (FAILED, 3, 1, 2)
    rejects = {r["full_name"]: r for r in read_rejects(lake, CONTRACT, state["run_id"]).collect()}
    assert rejects["Name 2"]["amount"] == "junk"
    assert rejects["Name 2"]["reasons"] == ["not_null:amount", "cast_failed:amount"]
    with pytest.raises(NotLoaded):
        read_silver(lake, CONTRACT, DAY)


def test_silver_reads_the_landed_day_and_a_rerun_takes_its_place(spark, lake):
    land_raw(raw(spark, [line("1", "a")]), lake.bronze("transactions"), DAY)
    land_raw(raw(spark, [line("2", "b")]), lake.bronze("transactions"), NEXT)
    for when in (DAY, NEXT):
        silver_job(spark, lake, CONTRACT, when, as_of=AS_OF)
    land_raw(raw(spark, [line("1", "a"), line("3", "c")]), lake.bronze("transactions"), DAY)
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF)
    assert rows(read_silver(lake, CONTRACT, DAY).select("account_no")) == [("a",), ("c",)]
    assert rows(read_silver(lake, CONTRACT, NEXT).select("account_no")) == [("b",)]


def test_nothing_valid_reads_as_empty(spark, lake):
    lenient = replace(CONTRACT, quality_rules=replace(CONTRACT.quality_rules, min_valid_rate=0.0))
    silver_job(spark, lake, lenient, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a", amount="junk")]))
    assert read_silver(lake, lenient, DAY).count() == 0


def test_no_row_is_lost_between_outcomes(spark, lake):
    lines = [line(str(i), f"a{i}", amount=None if i % 4 == 0 else "1", id_type="AU" if i % 3 else "MA") for i in range(40)]
    lenient = replace(CONTRACT, quality_rules=replace(CONTRACT.quality_rules, min_valid_rate=0.0))
    run = silver_job(spark, lake, lenient, DAY, as_of=AS_OF, raw=raw(spark, lines), null_policy="sql")
    # No risk amount is given: under this policy every row that fails nothing is undecided.
    assert (run.rows_rejected, run.rows_indeterminate) == (14, 26)
    assert run.rows_read == 40 == run.rows_valid + run.rows_rejected + run.rows_indeterminate


def test_customer_change_and_active_lookup(spark, lake):
    day(spark, lake, [line("1", "a"), line("2", "b")], DAY)
    day(spark, lake, [line("1", "c", city="NEW", at="1998-06-01 00:00:00")], NEXT)
    versions = rows(customer_versions(lake).select("sk_customer", "id_number", "city", "is_active"))
    assert versions == [(1, 1, "TOWN", False), (2, 2, "TOWN", True), (3, 1, "NEW", True)]
    assert [f[:2] for f in facts(lake)] == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(f[2] for f in facts(lake)) == [1, 2, 3]


def test_rerunning_a_day_adds_nothing(spark, lake):
    lines = [line("1", "a"), line("2", "b")]
    day(spark, lake, lines, DAY)
    before = facts(lake)
    files = lake.ledger.view().files("dim_customer")
    day(spark, lake, lines, DAY)
    assert facts(lake) == before
    assert lake.ledger.view().files("dim_customer") == files  # nothing changed, nothing rewritten


def test_days_one_by_one_equal_one_batch(spark, lake):
    batches = [[line(str(i), f"{d}-{i}", at=f"1998-05-0{d} 0{i}:00:00") for i in range(1, 4)] for d in (1, 2, 3)]
    for d, lines in enumerate(batches):
        day(spark, lake, lines, DAY + timedelta(days=d))
    other = Lake(spark, scratch_path(spark, "lake"))
    day(spark, other, sum(batches, []), DAY)
    pick = ("account_no", "sk_customer", "sk_product", "sk_date")
    assert rows(read_fact(lake, FACT_PROCESS, CONTRACT.schema).select(*pick)) == rows(
        read_fact(other, FACT_PROCESS, CONTRACT.schema).select(*pick)
    )


def test_late_rows_need_lateness_and_come_once(spark, lake):
    day(spark, lake, [line("1", "a", at="1998-05-10 00:00:00")], DAY)
    late = [line("1", "b", at="1998-05-09 00:00:00"), line("1", "a", at="1998-05-10 00:00:00")]
    day(spark, lake, late, NEXT)
    assert [f[0] for f in facts(lake)] == ["a"]
    gold_job(spark, lake, FACT_PROCESS, CONTRACT, NEXT, lateness=timedelta(days=5))
    gold_job(spark, lake, FACT_PROCESS, CONTRACT, NEXT, lateness=timedelta(days=5))
    assert [f[0] for f in facts(lake)] == ["a", "b"]
    assert lake.ledger.watermark("transactions") == datetime(1998, 5, 10)


def test_future_time_does_not_poison_the_watermark(spark, lake):
    day(spark, lake, [line("1", "a", at="2099-01-01 00:00:00")], DAY)
    assert lake.ledger.watermark("transactions") == AS_OF


def test_orphans_keep_their_natural_keys(spark, lake):
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
    for config in DIMENSIONS:
        gold_job(spark, lake, config, CONTRACT, DAY)
    silver_job(spark, lake, CONTRACT, NEXT, as_of=AS_OF,
               raw=raw(spark, [line("1", "b"), line("9", "c"), line("1", "d", product="CARD")]))
    run = gold_job(spark, lake, FACT_PROCESS, CONTRACT, NEXT)
    assert (run.rows_inserted, run.rows_rejected) == (1, 2)
    orphans = read_orphans(lake, FACT_PROCESS, CONTRACT.schema)
    assert rows(orphans.select("account_no", "id_number", "product_type")) == [("c", 9, "LOAN"), ("d", 1, "CARD")]
    assert [f[0] for f in facts(lake)] == ["b"]


def test_orphans_are_replayed_once(spark, lake):
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
    for config in DIMENSIONS:
        gold_job(spark, lake, config, CONTRACT, DAY)
    silver_job(spark, lake, CONTRACT, NEXT, as_of=AS_OF,
               raw=raw(spark, [line("1", "b"), line("9", "c"), line("1", "d", product="CARD"), line("8", "e", product="X")]))
    gold_job(spark, lake, FACT_PROCESS, CONTRACT, NEXT)
    keys = {f[0]: f[2] for f in rows(read_orphans(lake, FACT_PROCESS, CONTRACT.schema).select("account_no", "id_number", "sk_transaction"))}
    files = lake.ledger.view().files("fact_transactions")
    run = replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, NEXT)
    assert (run.rows_read, run.rows_inserted) == (3, 0) and lake.ledger.view().files("fact_transactions") == files
    gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, NEXT)
    run = replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, NEXT)
    assert (run.rows_read, run.rows_inserted, run.rows_rejected) == (3, 1, 2)
    assert [(f[0], f[2]) for f in facts(lake) if f[0] != "b"] == [("c", keys["c"])]
    orphans = read_orphans(lake, FACT_PROCESS, CONTRACT.schema)
    assert rows(orphans.select("account_no", "sk_transaction")) == [("d", keys["d"]), ("e", keys["e"])]
    gold_job(spark, lake, DIMENSIONS[1], CONTRACT, NEXT)
    replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, NEXT)
    assert [f[0] for f in facts(lake)] == ["b", "c", "d", "e"]
    assert replay_orphans(spark, lake, FACT_PROCESS, CONTRACT.schema, NEXT).rows_read == 0


def test_first_versions_reach_back_where_asked(spark, lake):
    config = copy.deepcopy(FACT_PROCESS)
    customer = next(d for d in config["target"]["load"][0]["lookups"] if d.get("versioned"))
    customer.update(as_of=True, open_start=True)
    for when, city, account in ((DAY, "TOWN", "a"), (NEXT, "NEW", "b")):
        lines = [line("1", account, city=city, at="1998-05-01 10:00:00"), line("1", account + "2", city=city, at=f"{when} 09:00:00")]
        daily_load(spark, lake, CONTRACT, DIMENSIONS, [config], when, as_of=AS_OF, raw=raw(spark, lines), use_watermark=False)
    assert [f[:2] for f in facts(lake)] == [("a", 1), ("a2", 1), ("b", 1), ("b2", 2)]
    assert read_orphans(lake, config, CONTRACT.schema).count() == 0


def test_as_of_lookup_in_the_job(spark, lake):
    day(spark, lake, [line("1", "a", at="2024-01-01 08:00:00")], DAY, use_watermark=False)
    silver_job(spark, lake, CONTRACT, NEXT, as_of=AS_OF,
               raw=raw(spark, [line("1", "b", city="NEW", at="2024-01-01 09:00:00"),
                               line("1", "c", city="NEW", at="2024-01-02 09:00:00")]))
    gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, NEXT)
    config = copy.deepcopy(FACT_PROCESS)
    next(d for d in config["target"]["load"][0]["lookups"] if d.get("versioned"))["as_of"] = True
    gold_job(spark, lake, config, CONTRACT, NEXT, use_watermark=False)
    assert [f[:2] for f in facts(lake)] == [("a", 1), ("b", 1), ("c", 2)]


def test_older_date_is_refused(spark, lake):
    day(spark, lake, [line("1", "a")], NEXT)
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a", city="OLD")]))
    with pytest.raises(StaleBatch):
        gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, DAY)


@pytest.mark.parametrize(
    "change",
    [
        lambda c: c["target"]["load"].__setitem__(0, {"step": "sql"}),
        lambda c: c["target"]["load"][0].pop("keys"),
        lambda c: c.pop("target"),
        lambda c: c["transformations"].append({"type": "nope"}),
    ],
)
def test_bad_configs_fail_on_record(spark, lake, change):
    config = copy.deepcopy(CUSTOMER_PROCESS)
    change(config)
    with pytest.raises((ConfigError, ValueError)):
        gold_job(spark, lake, config, CONTRACT, DAY)
    assert lake.ledger.state().first()["status"] == FAILED


@pytest.mark.parametrize(
    "query, why",
    [
        ("DROP TABLE t", "no query"),
        ("INSERT INTO {staged} SELECT 1", "no query"),
        ("WITH a AS (SELECT * FROM secret) SELECT * FROM a", "reads .*secret"),
        ("SELECT * FROM {staged} WHERE EXISTS (SELECT 1 FROM secret)", "reads .*secret"),
        ("SELECT * FROM parquet.`/x`", "reads"),
        ("SELECT * FROM {unlisted}", "names 'unlisted'"),
        ("SELECT * FROM {missing}", "nothing was loaded"),
    ],
)
def test_sql_steps_are_checked(spark, lake, query, why):
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
    config = {"process_type": "p", "source": {"source_name": "transactions"}, "transformations": [],
              "target": {"gold_path": "p", "load": [{"step": "sql", "table": "t", "query": query, "reads": ["missing"]}]}}
    with pytest.raises(ConfigError, match=why):
        gold_job(spark, lake, config, CONTRACT, DAY)
    config["target"]["load"][0] |= {"mode": "merge"}
    with pytest.raises(ConfigError, match="appends or replaces"):
        gold_job(spark, lake, config, CONTRACT, DAY)
    assert lake.ledger.view().files("t") == []


def test_sql_steps_append_and_replace(spark, lake):
    from oreline.plans.lake import read_files

    schema = T.StructType([CONTRACT.schema["account_no"], T.StructField("twice", T.LongType())])
    for mode, expected in (("append", ["a", "a"]), ("replace", ["a"])):
        for _ in range(2):
            silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
            step = {"step": "sql", "table": mode, "mode": mode, "args": {"n": 2},
                    "query": "SELECT account_no, id_number * :n AS twice FROM {staged}"}
            gold_job(spark, lake, {"process_type": mode, "source": {"source_name": "transactions"},
                                   "target": {"gold_path": mode, "load": [step]}}, CONTRACT, DAY)
        found = read_files(lake, mode, lake.ledger.view().files(mode), schema)
        assert rows(found) == [(a, 2) for a in expected]


def broadcast_part(text):
    """The lines of a plan below its broadcasts."""
    below, depth = [], None
    for row in text.splitlines():
        at = len(row) - len(row.lstrip(" :+-"))
        depth = None if depth is not None and at <= depth else depth
        if depth is not None:
            below.append(row)
        elif "BroadcastExchange" in row:
            depth = at
    return "\n".join(below)


@pytest.mark.parametrize(
    "query",
    [
        "SELECT account_no FROM {first} WHERE product_type IN (SELECT product_type FROM {staged})",
        "WITH s AS (SELECT product_type FROM {staged} UNION ALL SELECT product_type FROM {staged})"
        " SELECT account_no FROM {first} WHERE product_type IN (SELECT product_type FROM s)",
        "SELECT account_no FROM {first} LEFT JOIN {staged} s USING (product_type) GROUP BY account_no HAVING count(s.text) > 0",
    ],
)
def test_sql_steps_do_not_broadcast_rows_that_are_small_as_files_only(spark, lake, monkeypatch, query):
    """Two million copies of a row are some kilobytes of Parquet, and 88 MB of values."""
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a"), line("2", "b", product="CARD")]))
    planned, write = {}, DataFrameWriter.parquet

    def spy(writer, path, *args, **kwargs):
        planned[path.split("/")[-2]] = plan(writer._df)
        return write(writer, path, *args, **kwargs)

    @handler("copied")
    def copied(staged, config, ctx):
        return staged.where("account_no = 'a'").crossJoin(spark.range(2_000_000)).select(F.lit("LOAN" * 5).alias("text"), "product_type")

    def load(process, step, **more):
        gold_job(spark, lake, {"process_type": process, "source": {"source_name": "transactions"}, **more,
                               "target": {"gold_path": process, "load": [{"step": "sql", "table": process, **step}]}}, CONTRACT, DAY)

    load("first", {"query": "SELECT account_no, product_type FROM {staged}"})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    load("second", {"query": query, "reads": ["first"]}, custom_handler="copied")
    found = read_appended(lake, "second", T.StructType([CONTRACT.schema["account_no"]]))
    assert rows(found) == [("a",)]
    sent = broadcast_part(planned["second"])
    assert "/gold/second/" in planned["second"] and ("/gold/second/" not in sent or "HashAggregate" in sent)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_a_watermark_needs_a_fact_key(spark, lake):
    config = copy.deepcopy(FACT_PROCESS)
    del config["target"]["load"][0]["key"]
    with pytest.raises(ConfigError, match="needs 'key'"):
        gold_job(spark, lake, config, CONTRACT, DAY)


def test_missing_silver_fails_on_record(spark, lake):
    with pytest.raises(NotLoaded):
        gold_job(spark, lake, CUSTOMER_PROCESS, CONTRACT, DAY)
    assert lake.ledger.state().first()["status"] == FAILED


def test_first_failure_stops_the_load(spark, lake):
    strict = replace(CONTRACT, quality_rules=replace(CONTRACT.quality_rules, min_valid_rate=1.0))
    with pytest.raises(QualityGateError):
        daily_load(spark, lake, strict, DIMENSIONS, FACTS, DAY, as_of=AS_OF,
                   raw=raw(spark, [line("1", "a", amount="junk")]))
    assert lake.ledger.state().count() == 1


def test_uncommitted_fact_rows_are_invisible(spark, lake):
    day(spark, lake, [line("1", "a")], DAY)
    committed = facts(lake)
    # What a run leaves behind that died before its SUCCESS event.
    stray = spark.read.parquet(lake.table("fact_transactions")).drop("run_id")
    stray.write.partitionBy("resolved", "month_key").parquet(
        f"{lake.table('fact_transactions')}/run_id=run-dead"
    )
    assert facts(lake) == committed


def test_repeated_micro_batch_is_a_no_op(spark, lake):
    lines = [line("1", "a"), line("2", "b")]
    first = day(spark, lake, lines, DAY, batch_id=0, use_watermark=False)
    again = day(spark, lake, lines, DAY, batch_id=0, use_watermark=False)
    assert first == again
    assert len(facts(lake)) == 2


def test_stream_takes_each_file_once(spark, lake):
    incoming, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    for lines in ([line("1", "a")], [line("2", "b", at="1997-01-01 00:00:00")], []):
        if lines:
            raw(spark, lines).write.mode("append").option("header", True).csv(incoming)
        stream_daily(spark, lake, CONTRACT, DIMENSIONS, FACTS, incoming, checkpoint, as_of=AS_OF,
                     date_of=lambda batch: DAY).awaitTermination()
    # The older second batch is loaded too: batches count, not event times.
    assert [f[0] for f in facts(lake)] == ["a", "b"]


def test_a_new_checkpoint_loads_its_own_batches(spark, lake):
    for account in ("a", "b"):
        incoming, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
        raw(spark, [line("1", account)]).write.option("header", True).csv(incoming)
        for _ in range(2):
            stream_daily(spark, lake, CONTRACT, DIMENSIONS, FACTS, incoming, checkpoint, as_of=AS_OF,
                         date_of=lambda batch: DAY).awaitTermination()
    assert [f[0] for f in facts(lake)] == ["a", "b"]


def test_two_load_steps_keep_their_own_keys_and_snapshots(spark, lake):
    config = copy.deepcopy(CUSTOMER_PROCESS)
    config["target"]["load"].append(
        {"step": "insert_new", "table": "customer_days", "key": ["id_type", "id_number", "valid_from"],
         "surrogate": "sk_day"}
    )
    both = [line("1", "a"), line("2", "b")]
    for when, lines in ((DAY, both), (NEXT, both), (date(2024, 1, 3), [*both, line("3", "c")])):
        daily_load(spark, lake, CONTRACT, [config], [], when, as_of=AS_OF, raw=raw(spark, lines))
    versions = rows(customer_versions(lake).select("sk_customer", "id_number", "is_active"))
    assert versions == [(1, 1, True), (2, 2, True), (3, 3, True)]
    days = spark.read.parquet(lake.table("customer_days")).select("sk_day")
    assert rows(days) == [(i,) for i in range(1, 8)]


def test_stream_silver_one_file_per_batch(spark, lake):
    incoming, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    for i in range(2):
        raw(spark, [line(str(i), f"a{i}")]).coalesce(1).write.mode("append").option("header", True).csv(incoming)
    stream_silver(spark, lake, CONTRACT, incoming, checkpoint, AS_OF, lambda batch: DAY, 1).awaitTermination()
    runs = lake.ledger.successes("silver", "transactions")
    assert rows(runs.select("batch_id", "rows_valid")) == [(0, 1), (1, 1)]


def test_csv_report_handler_in_a_job(spark, lake):
    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
    config = copy.deepcopy(CUSTOMER_PROCESS)
    config["custom_handler"] = "csv_report"
    config["custom_output"] = {"path": scratch_path(spark, "report")}
    gold_job(spark, lake, config, CONTRACT, DAY)
    report = spark.read.option("header", True).csv(f"{config['custom_output']['path']}/dim_customer")
    assert report.count() == 1 and "row_hash" in report.columns


def test_insert_counts_match_the_table(spark, lake):
    day(spark, lake, [line("1", "a"), line("2", "b", product="CARD")], DAY)
    counts = {r["source_name"]: r["rows_inserted"] for r in lake.ledger.state().collect()}
    assert counts == {"transactions": 0, "dim_customer": 2, "dim_product": 2, "dim_date": 1, "fact_transactions": 2}


def test_sliced_lookups_in_the_job(spark, lake):
    """Dimensions too large to broadcast give the same facts."""
    lines = [line("1", f"a{i}") for i in range(30)] + [line("2", "b"), line("3", "c", product="CARD")]
    config = copy.deepcopy(FACT_PROCESS)
    for lookup in config["target"]["load"][0]["lookups"]:
        lookup["broadcast_bytes"] = -1
    daily_load(spark, lake, CONTRACT, DIMENSIONS, [config], DAY, as_of=AS_OF, raw=raw(spark, lines))
    other = Lake(spark, scratch_path(spark, "lake"))
    day(spark, other, lines, DAY)
    assert [f[:2] for f in facts(lake)] == [f[:2] for f in facts(other)]


def test_fact_reads_prune_runs_and_months(spark, lake):
    day(spark, lake, [line("1", "a")], DAY)
    month = read_fact(lake, FACT_PROCESS, CONTRACT.schema).where("month_key = 199805").select("amount")
    scan = next(x for x in plan(month).splitlines() if "FileScan parquet [amount" in x)
    assert "PartitionFilters: [" in scan and "month_key" in scan.split("PartitionFilters")[1] and "resolved" in scan
    assert "ReadSchema: struct<amount:decimal(18,2)>" in scan


def test_reads_plan_only_committed_files(spark, lake):
    day(spark, lake, [line("1", "a")], DAY)
    stray = f"{lake.table('fact_transactions')}/run_id=run-dead/resolved=true/month_key=199805"
    spark.read.parquet(f"{lake.table('fact_transactions')}").drop("run_id", "resolved", "month_key").write.parquet(stray)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows_ = read_fact(lake, FACT_PROCESS, CONTRACT.schema)
        assert "Exchange" not in plan(rows_) and "Join" not in plan(rows_)
        assert rows_.inputFiles() and not [f for f in rows_.inputFiles() if "run-dead" in f]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    manifest = lake.ledger.view().files("fact_transactions")
    assert [(f.rows, f.low, f.high) for f in manifest] == [(1, "1998-05-01 10:00:00", "1998-05-01 10:00:00")]


def interleaved(other):
    """A handler that lets another load run between the read and the commit of its own, once."""
    from oreline.operators.transforms import handler

    state = {"left": 1}

    @handler("interleave")
    def run(df, config, ctx):
        if state["left"]:
            state["left"] = 0
            other()
        return df


@pytest.mark.parametrize("retries", [0, 1])
def test_concurrent_loads_of_a_process(spark, lake, retries):
    from oreline.suite.model import PRODUCT_PROCESS

    for when, products in ((DAY, "AB"), (NEXT, "BC")):
        silver_job(spark, lake, CONTRACT, when, as_of=AS_OF, raw=raw(spark, [line("1", p, product=p) for p in products]))
    interleaved(lambda: gold_job(spark, lake, PRODUCT_PROCESS, CONTRACT, NEXT))
    slow = {**copy.deepcopy(PRODUCT_PROCESS), "custom_handler": "interleave"}
    keys = {"B": 1, "C": 2}
    if retries:
        gold_job(spark, lake, slow, CONTRACT, DAY, retries=retries)
        keys["A"] = 3
    else:
        with pytest.raises(ConcurrentLoad, match="dim_product"):
            gold_job(spark, lake, slow, CONTRACT, DAY)
    schema = insert_schema(T.StructType([CONTRACT.schema["product_type"]]), {"surrogate": "sk_product"})
    assert {r.product_type: r.sk_product for r in read_appended(lake, "dim_product", schema).collect()} == keys
    lost = lake.ledger.state().where("status = 'FAILED'").collect()
    assert len(lost) == 1 and "has changed dim_product" in lost[0]["error_msg"] and not lost[0]["added"]


def test_a_changed_key_rewrites_its_bucket_only(spark, lake):
    people = [line(str(i), f"a{i}") for i in range(200)]
    day(spark, lake, people, DAY)
    before = {f.path: f for f in lake.ledger.view().files("dim_customer")}
    assert len({f.part for f in before.values()}) == 16 and sum(f.rows for f in before.values()) == 200
    day(spark, lake, [line("7", "b", city="NEW"), line("8", "c")], NEXT)
    after = {f.path: f for f in lake.ledger.view().files("dim_customer")}
    gone, new = before.keys() - after.keys(), after.keys() - before.keys()
    assert {before[p].part for p in gone} == {after[p].part for p in new if after[p].part != "closed"}
    assert len(gone) == 1 and [after[p].rows for p in new if after[p].part == "closed"] == [1]
    versions = customer_versions(lake)
    assert (versions.count(), versions.where("is_active").count()) == (201, 200)
    config = copy.deepcopy(CUSTOMER_PROCESS)
    config["target"]["load"][0]["buckets"] = 4
    with pytest.raises(ConfigError, match="16 buckets"):
        gold_job(spark, lake, config, CONTRACT, NEXT)


def test_a_gold_job_needs_few_spark_jobs(spark, lake):
    from oreline.suite.model import DATE_PROCESS

    silver_job(spark, lake, CONTRACT, DAY, as_of=AS_OF, raw=raw(spark, [line("1", "a")]))
    for config, most in ((DATE_PROCESS, 20), (CUSTOMER_PROCESS, 30)):
        group = f"count-{config['process_type']}"
        spark.sparkContext.setJobGroup(group, group)
        gold_job(spark, lake, config, CONTRACT, DAY)
        spark.sparkContext.setJobGroup("", "")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < most


def test_staged_sets_of_reruns_lie_side_by_side(spark, lake):
    from oreline.plans.gold import read_staged
    from oreline.suite.model import PRODUCT_PROCESS

    schema = T.StructType([CONTRACT.schema["product_type"]])
    for product in "AB":
        day(spark, lake, [line("1", product, product=product)], DAY, use_watermark=False)
        assert rows(read_staged(lake, PRODUCT_PROCESS, DAY, schema)) == [(product,)]
    with pytest.raises(NotLoaded):
        read_staged(lake, PRODUCT_PROCESS, NEXT, schema)


def test_files_for_the_landing_stream_are_compressed(spark, folder, monkeypatch):
    import os

    from conftest import DATA

    from oreline.suite import QUERIES, streams

    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: f"{folder}/{label}")
    assert QUERIES["stream_ingest"](spark, DATA).count() == spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    files = [f for f in os.listdir(f"{folder}/incoming") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.snappy") for f in files)
