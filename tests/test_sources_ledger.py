from __future__ import annotations

import os
import threading
from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.ledger import (
    FAILED,
    RUNNING,
    SUCCESS,
    ConcurrentLoad,
    DataFile,
    Ledger,
    WatermarkMissing,
    last_keys,
)
from oreline.sources.metadata import MetadataFolder
from oreline.session import discard, materialize, scratch_path, shared_folder
from oreline.sources.readers import (
    arrival_audit,
    landed_files,
    on_day,
    read_csv,
    read_csv_by_header,
    read_if_present,
    text_schema,
)
from oreline.sources.writers import land_raw, write_partitioned, write_rejects, write_report


def put(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as out:
        out.write(text)


def test_accented_headers_and_separators(spark, folder):
    put(f"{folder}/a.csv", "número;ciudad\n1;BOGOTÁ\n2;\n")
    df = read_csv(spark, f"{folder}/a.csv", delimiter=";")
    assert df.columns == ["número", "ciudad"]
    assert rows(df) == [("1", "BOGOTÁ"), ("2", None)]
    assert dict(df.dtypes) == {"número": "string", "ciudad": "string"}
    assert dict(read_csv(spark, f"{folder}/a.csv", ";", infer_schema=True).dtypes)["número"] == "int"


@pytest.mark.parametrize("encoding", ["utf-8-sig", "UTF-8-BOM"])
def test_bom_is_stripped(spark, folder, encoding):
    put(f"{folder}/a.csv", "id,v\n1,x\n", "utf-8-sig")
    assert read_csv(spark, f"{folder}/a.csv", encoding=encoding).columns == ["id", "v"]


def test_latin1(spark, folder):
    put(f"{folder}/a.csv", "id,v\n1,ñ\n", "latin-1")
    assert rows(read_csv(spark, f"{folder}/a.csv", encoding="ISO-8859-1")) == [("1", "ñ")]


def test_declared_headers_are_checked(spark, folder):
    put(f"{folder}/a.csv", "id,v\n1,x\n")
    assert rows(read_csv(spark, f"{folder}/a.csv", headers=["id", "v"])) == [("1", "x")]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{folder}/a.csv", headers=["v", "id"]).collect()


def test_partition_filter_prunes(spark, folder):
    df = spark.range(10).select(
        "id", F.lit("2024").alias("year"), F.lit("01").alias("month"),
        F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0").alias("day"),
    )
    write_partitioned(df, f"{folder}/t", ["year", "month", "day"])
    one = on_day(spark.read.parquet(f"{folder}/t"), date(2024, 1, 2))
    assert rows(one.select("id")) == [(1,), (4,), (7,)]
    text = plan(on_day(spark.read.parquet(f"{folder}/t"), date(2024, 1, 2)))
    assert "day" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_overwriting_one_day_keeps_the_others(spark, folder):
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, day string")
    write_partitioned(df, f"{folder}/t", ["day"])
    write_partitioned(spark.createDataFrame([(3, "02")], "id int, day string"), f"{folder}/t", ["day"])
    assert rows(spark.read.parquet(f"{folder}/t").select("id")) == [(1,), (3,)]


def test_rejects_are_text(spark, folder):
    df = spark.createDataFrame([(1, None, "01")], "n int, b boolean, day string")
    write_rejects(df, f"{folder}/r", ["day"])
    stored = spark.read.schema("n string, b string, day string").parquet(f"{folder}/r")
    assert rows(stored) == [("1", None, "01")]


def test_report_file_count(spark, folder):
    write_report(spark.range(100).repartition(5), f"{folder}/one", files=1)
    assert landed_files(spark, f"{folder}/one").where("path like '%.csv'").count() == 1
    assert read_csv(spark, f"{folder}/one").count() == 100


def test_landing_lists_files_without_reading_them(spark, folder):
    raw = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string")
    land_raw(raw, f"{folder}/bronze", date(2024, 3, 5))
    land_raw(raw, f"{folder}/bronze", date(2024, 3, 6))
    landed = landed_files(spark, f"{folder}/bronze")
    assert "content" not in landed.columns
    assert rows(landed.select("year", "month", "day").distinct()) == [(2024, 3, 5), (2024, 3, 6)]
    assert rows(read_csv(spark, f"{folder}/bronze/year=2024/month=03/day=05")) == rows(raw)


def test_missing_table_reads_as_empty(spark, folder):
    schema = text_schema(["a"])
    assert read_if_present(spark, f"{folder}/none", schema).count() == 0
    spark.createDataFrame([("x",)], schema).write.parquet(f"{folder}/some")
    assert read_if_present(spark, f"{folder}/some", T.StructType([]), infer=True).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = materialize(spark.range(3))
    assert kept.count() == 3
    files = [f.removeprefix("file://") for f in kept.inputFiles()]
    assert all(map(os.path.exists, files))
    discard(kept)
    assert files and not any(map(os.path.exists, files))
    with pytest.raises(ValueError, match="not below"):
        discard(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_ledger_success_and_failure(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    assert ledger.state().count() == 0 and ledger.last_success("j", "s") is None
    with ledger.run("j", "s", date(2024, 1, 1)) as run:
        state = ledger.state().first()
        assert (state["status"], state["run_id"]) == (RUNNING, run.run_id)
        run.rows_read = 5
    with pytest.raises(RuntimeError):
        with ledger.run("j", "s", date(2024, 1, 2)):
            raise RuntimeError("it's broken " + "x" * 3000)
    by_day = {r["execution_date"]: r for r in ledger.state().collect()}
    good, bad = by_day[date(2024, 1, 1)], by_day[date(2024, 1, 2)]
    assert (good["status"], good["rows_read"], good["error_msg"]) == (SUCCESS, 5, None)
    assert bad["status"] == FAILED and bad["error_msg"] == "it's broken " + "x" * 3000
    assert ledger.last_success("j", "s")["run_id"] == good["run_id"]
    assert ledger.last_success("j", "s", date(2024, 1, 2)) is None


def test_watermark_keeps_microseconds_and_counts_only_commits(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    assert ledger.watermark("s") == datetime(2000, 1, 1)
    with pytest.raises(WatermarkMissing):
        ledger.watermark("s", seed=None)
    moment = datetime(2024, 1, 1, 10, 0, 0, 123456)
    with ledger.run("j", "p") as run:
        run.watermark_source, run.watermark_end = "s", moment
    with pytest.raises(RuntimeError):
        with ledger.run("j", "p") as run:
            run.watermark_source, run.watermark_end = "s", datetime(2030, 1, 1)
            raise RuntimeError
    assert ledger.watermark("s") == moment


def test_two_writers_never_take_one_version(spark, folder):
    log = MetadataFolder(spark, f"{folder}/log")
    assert log.names() == []
    assert log.create("1.json", "é") and not log.create("1.json", "other")
    assert log.read("1.json") == "é" and log.names() == ["1.json"]
    taken = []
    threads = [threading.Thread(target=lambda i=i: taken.append(log.create("2.json", str(i)))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == [False] * 7 + [True]


def test_a_thousand_runs_are_read_from_one_checkpoint_and_a_short_tail(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    days = spark.range(1000).select(
        F.format_string("run-%04d", "id").alias("run_id"), F.lit(1).alias("seq"), F.lit("j").alias("job_name"),
        F.lit("s").alias("source_name"), F.lit(SUCCESS).alias("status"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,int(id))").alias("watermark_end"),
        F.lit("s").alias("watermark_source"), F.expr("map('t', id)").alias("last_keys"),
    )
    ledger.restore(days)
    with pytest.raises(ValueError, match="empty ledger"):
        ledger.restore(days)
    for _ in range(40):
        with ledger.run("j", "s") as run:
            run.added = [DataFile("t", "rows", f"{run.run_id}/f", 1)]
    names = {f.rsplit("/", 1)[1] for f in ledger.events().inputFiles()}
    assert len([n for n in names if n.endswith(".parquet")]) == 1 and len(names) <= 33
    assert ledger.state().count() == 1040 and ledger.version() == 81
    view = ledger.view()
    assert view.ask(**last_keys(["t", "u"])).asDict() == {"t": 999, "u": 0}
    assert ledger.watermark("s") == datetime(2026, 9, 26) and len(view.files("t")) == 40
    ledger.compact()
    assert [n.endswith(".parquet") for n in ledger.events().inputFiles()] == [True]
    ledger.expire()
    assert ledger.state().count() == 1040
    with ledger.run("j", "s") as run:
        pass
    assert ledger.state().count() == 1041 and ledger.last_success("j", "s")["run_id"] == run.run_id


def test_a_long_checkpoint_is_written_by_several_tasks(spark, folder):
    """One task would hold the whole log; rows that added nothing are not even joined."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    log = spark.range(20_000).select(
        F.when(F.col("id") % 100 > 0, F.concat(F.lit("run-"), F.col("id"))).alias("run_id"), F.lit(1).alias("seq"),
        F.lit(SUCCESS).alias("status"), F.sha2(F.col("id").cast("string"), 256).alias("error_msg"),
    )
    spark.conf.set(size, "64k")
    try:
        ledger = Ledger(spark, f"{folder}/ledger", checkpoint=4)
        ledger.restore(log)
        assert len(ledger.events().inputFiles()) > 1
        with ledger.run("j", "s") as run:
            run.added = [DataFile("t", "rows", "f", 1), DataFile("t", "rows", "g", 2)]
        with ledger.run("j", "s") as run:
            run.removed = ledger.view().files("t")[:1]
        ledger.compact()
        assert len(ledger.events().inputFiles()) > 1
    finally:
        spark.conf.set(size, before)
    assert [f.path for f in ledger.view().files("t")] == ["g"] and ledger.events().count() == 20_004
    kept = ledger.events().where("job_name is null").select("run_id", "seq", "status", "error_msg")
    assert rows(kept) == rows(log)


def test_half_written_checkpoints_are_ignored(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger", checkpoint=4)
    with ledger.run("j", "s"):
        pass
    spark.range(1).write.parquet(f"{folder}/ledger/checkpoints/{4:020d}")
    assert ledger.state().count() == 1
    with ledger.run("j", "s"):
        pass  # writes the checkpoint in its place
    assert ledger.state().count() == 2 and len(ledger.events().inputFiles()) == 1


def test_a_run_that_lost_publishes_nothing(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")

    def change(run, path):
        run.changes = {"t"}
        run.added, run.last_keys = [DataFile("t", "rows", path, 1)], {"t": 1}

    with pytest.raises(ConcurrentLoad, match="has changed t since version 1"):
        with ledger.run("j", "s") as slow:
            with ledger.run("j", "other") as quick:
                change(quick, "quick")
            with ledger.run("j", "s"):
                pass  # changes nothing: no conflict
            change(slow, "slow")
    assert [f.path for f in ledger.view().files("t")] == ["quick"]
    with ledger.run("j", "s") as run:
        run.removed = ledger.view().files("t")
        run.added = [DataFile("t", "rows", "newer", 2), DataFile("u", "rows", "quick", 3)]
    for _ in range(2):
        assert [f.path for f in ledger.view().files("t")] == ["newer"] and ledger.view().files("u")[0].rows == 3
        ledger.compact()
    assert ledger.events().selectExpr("sum(size(added))", "sum(size(removed))").first()[:] == (2, 0)


def test_runs_may_write_the_ledger_side_by_side(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")

    def work(i):
        with ledger.run("j", f"s{i}"):
            pass

    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert ledger.state().where(F.col("status") == SUCCESS).count() == 4


def test_files_with_other_headers(spark, folder):
    import gzip

    os.makedirs(f"{folder}/a b/day=1")
    base = f"{folder}/a b/day=1"
    for name, text in (("1.csv", "\ufeffid;v\n1;x\n"), ("2.csv", "v;id\n\"y;z\";2\n"), ("3.csv", ""), ("4.csv", "id\n3\n"), ("5.csv", "id;v\n4;ñ\n")):
        with open(f"{base}/{name}", "w", encoding="utf-8") as file:
            file.write(text)
    with gzip.open(f"{base}/6.csv.gz", "wt", encoding="utf-8") as file:
        file.write("v;id\nw;5\n")
    got = read_csv_by_header(spark, base, ";", "utf-8-sig").select("id", "v")
    assert rows(got) == [("1", "x"), ("2", "y;z"), ("3", None), ("4", "ñ"), ("5", "w")]


def test_arrival_audit_where_nothing_has_landed(spark, folder):
    expected = spark.createDataFrame([("s", 2024, 1, 2)], "source_name string, year int, month int, day int")
    missing = arrival_audit(expected, landed_files(spark, f"{folder}/nowhere"))
    assert missing.count() == 1
