"""Run ledger: a log of numbered events that also decides what is published.

A run appends a RUNNING event and later one terminal event.  Events are files with consecutive version numbers, each
created only if absent, so two writers never take the same number.  A SUCCESS event holds all that a load
publishes: its watermark, its highest surrogate keys, and the data files that it adds to tables or takes out of them.

* Concurrency is optimistic.  A load works on the log as of some version.  If, when it commits, a newer event has
  changed a table that it changes too, it has lost: :class:`ConcurrentLoad`, and nothing of it is ever read.
* Every ``CHECKPOINT`` versions the whole log is written as Parquet: one file, or several where the log is long.  Readers
  take the newest complete checkpoint and the events behind it; a marker file, created last, switches to it at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.literals import instant
from oreline.sources.metadata import MetadataFolder

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
WATERMARK_SEED = datetime(2000, 1, 1)

#: Versions from one checkpoint to the next.
CHECKPOINT = 32

_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampNTZType()
DATA_FILE = T.StructType(
    [
        T.StructField(name, kind, True)
        for name, kind in (
            ("table", _TEXT),
            ("part", _TEXT),
            ("path", _TEXT),
            ("rows", _COUNT),
            ("low", _TEXT),
            ("high", _TEXT),
        )
    ]
)
SCHEMA = T.StructType(
    [
        T.StructField(name, kind, True)
        for name, kind in (
            ("version", _COUNT),
            ("run_id", _TEXT),
            ("seq", T.IntegerType()),
            ("job_name", _TEXT),
            ("source_name", _TEXT),
            ("execution_date", T.DateType()),
            ("stream_id", _TEXT),
            ("batch_id", _COUNT),
            ("started_at", _TIME),
            ("finished_at", _TIME),
            ("watermark_source", _TEXT),
            ("watermark_start", _TIME),
            ("watermark_end", _TIME),
            ("rows_read", _COUNT),
            ("rows_valid", _COUNT),
            ("rows_rejected", _COUNT),
            ("rows_indeterminate", _COUNT),
            ("rows_inserted", _COUNT),
            ("rows_updated", _COUNT),
            ("last_keys", T.MapType(_TEXT, _COUNT)),
            ("added", T.ArrayType(DATA_FILE)),
            ("removed", T.ArrayType(DATA_FILE)),
            ("status", _TEXT),
            ("error_msg", _TEXT),
        )
    ]
)


class WatermarkMissing(LookupError):
    """No load has set a watermark for the source, and no seed was given."""


class ConcurrentLoad(RuntimeError):
    """Another load changed a table since this one read it; nothing of this one was published."""


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class DataFile:
    """A committed file: ``path`` below its table's folder, ``part`` names its role there.

    ``low`` and ``high`` bound the values of the column that the table is laid out by, as text that sorts like them.
    """

    table: str
    part: str
    path: str
    rows: int
    low: str | None = None
    high: str | None = None


@dataclass
class Run:
    """One run.  ``batch_id`` counts within the stream ``stream_id``; ``last_keys`` holds the highest surrogate key by
    table, ``added`` and ``removed`` the files by which it changes tables.  ``read_version`` is the version of the log it works
    on, and ``changes`` all tables that it may change, even if it turns out to add nothing."""

    run_id: str
    job_name: str
    source_name: str
    execution_date: date | None = None
    stream_id: str | None = None
    batch_id: int | None = None
    seq: int = 0
    started_at: datetime | None = None
    finished_at: datetime | None = None
    watermark_source: str | None = None
    watermark_start: datetime | None = None
    watermark_end: datetime | None = None
    rows_read: int = 0
    rows_valid: int = 0
    rows_rejected: int = 0
    rows_indeterminate: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    last_keys: dict[str, int] = field(default_factory=dict)
    added: list[DataFile] = field(default_factory=list)
    removed: list[DataFile] = field(default_factory=list)
    status: str = RUNNING
    error_msg: str | None = None
    read_version: int = 0
    changes: set[str] = field(default_factory=set)

    def as_json(self, version: int) -> str:
        values = asdict(self)
        del values["read_version"], values["changes"]

        def text(value: object) -> str:
            return value.isoformat(sep="T") if isinstance(value, datetime) else str(value)

        return json.dumps({"version": version, **values}, default=text)


def _name(version: int) -> str:
    return f"{version:020d}"


class Ledger:
    def __init__(self, spark: SparkSession, path: str, checkpoint: int = CHECKPOINT):
        self.spark = spark
        self.path = path
        self.every = checkpoint
        self._log = MetadataFolder(spark, f"{path}/log")
        self._marks = MetadataFolder(spark, f"{path}/checkpoints")

    # --- reading -----------------------------------------------------------------------------------------

    def _listing(self) -> tuple[int, list[int]]:
        """The newest complete checkpoint's version (0: none) and the versions behind it."""
        marks = [int(n.removesuffix(".json")) for n in self._marks.names() if n.endswith(".json")]
        mark = max(marks, default=0)
        log = (int(n.removesuffix(".json")) for n in self._log.names())
        return mark, [v for v in log if v > mark]

    def version(self) -> int:
        mark, tail = self._listing()
        return max(tail, default=mark)

    def _events_of(self, mark: int, tail: list[int]) -> DataFrame:
        frames = []
        if mark:
            frames.append(self.spark.read.schema(SCHEMA).parquet(f"{self.path}/checkpoints/{_name(mark)}"))
        if tail:
            files = [f"{self.path}/log/{_name(v)}.json" for v in tail]
            # A damaged event is an error, not a row of nulls.
            frames.append(self.spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(files))
        if not frames:
            return self.spark.createDataFrame([], SCHEMA)
        return frames[0].unionByName(frames[1]) if len(frames) > 1 else frames[0]

    def events(self) -> DataFrame:
        """All events: one checkpoint and the few event files behind it."""
        return self._events_of(*self._listing())

    def view(self) -> LedgerView:
        """The log as it is now, under its version."""
        mark, tail = self._listing()
        return LedgerView(max(tail, default=mark), self._events_of(mark, tail))

    # --- writing -----------------------------------------------------------------------------------------

    def append(self, run: Run) -> int:
        """Add an event behind all others; returns its version."""
        while True:
            version = self.version() + 1
            if self._log.create(f"{_name(version)}.json", run.as_json(version)):
                self._compact_at(version)
                return version

    def commit(self, run: Run) -> int:
        """Add a SUCCESS event, unless a newer one has changed a table that this run changes."""
        checked = run.read_version
        while True:
            newest = self.version()
            for version in range(checked + 1, newest + 1):
                self._refuse_conflict(run, version)
            checked = newest
            if self._log.create(f"{_name(newest + 1)}.json", run.as_json(newest + 1)):
                self._compact_at(newest + 1)
                return newest + 1

    def _refuse_conflict(self, run: Run, version: int) -> None:
        name = f"{_name(version)}.json"
        if name not in self._log.names():
            raise ConcurrentLoad(f"event {version} has expired while {run.run_id} was at work")
        event = json.loads(self._log.read(name))
        if event["status"] != SUCCESS:
            return
        changed = {f["table"] for f in event["added"] + event["removed"]} | set(event["last_keys"])
        both = sorted(changed & (run.changes | set(run.last_keys)))
        if both:
            raise ConcurrentLoad(
                f"{event['run_id']} has changed {', '.join(both)} since version {run.read_version}"
            )

    def _compact_at(self, version: int) -> None:
        if version % self.every == 0:
            self.compact(version)

    def compact(self, version: int | None = None) -> None:
        """Write the log up to a version (by default the newest) as a checkpoint, and switch readers to it."""
        mark, tail = self._listing()
        version = version or max(tail, default=mark)
        if version <= mark:
            return
        events = self._events_of(mark, [v for v in tail if v <= version])
        self._write_checkpoint(events, version)

    def _write_checkpoint(self, events: DataFrame, version: int) -> None:
        # What an earlier attempt left behind has no marker, so nobody reads it.  Adaptive execution makes one file of a
        # short log and several of a long one, so no task holds it whole.
        path = f"{self.path}/checkpoints/{_name(version)}"
        _folded(events).hint("rebalance", "run_id").write.mode("overwrite").parquet(path)
        self._marks.create(f"{_name(version)}.json", json.dumps({"version": version}))

    def restore(self, events: DataFrame) -> None:
        """Start an empty ledger from events of another one, such as an older format's; columns it lacks are null."""
        if self.version():
            raise ValueError("only an empty ledger can be restored")
        kept = events.drop("version").withColumn("version", F.lit(1).cast("bigint"))
        missing = [f for f in SCHEMA.fields if f.name not in kept.columns]
        whole = kept.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        self._write_checkpoint(whole.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA.fields]), 1)

    def expire(self) -> None:
        """Remove event files and checkpoints older than the newest checkpoint but one."""
        marks = sorted(int(n.removesuffix(".json")) for n in self._marks.names() if n.endswith(".json"))
        for version in marks[:-2]:
            self._marks.remove(f"{_name(version)}.json")
            self._marks.remove(_name(version))
        if len(marks) > 1:
            for name in self._log.names():
                if int(name.removesuffix(".json")) <= marks[-2]:
                    self._log.remove(name)

    @contextmanager
    def run(
        self,
        job_name: str,
        source_name: str,
        execution_date: date | None = None,
        batch_id: int | None = None,
        stream_id: str | None = None,
    ) -> Iterator[Run]:
        """Open a run before any work; close it with what the body left in it."""
        run = Run(
            run_id=f"run-{uuid.uuid4().hex}",
            job_name=job_name,
            source_name=source_name,
            execution_date=execution_date,
            stream_id=stream_id,
            batch_id=batch_id,
            started_at=utc_now(),
        )
        run.read_version = self.append(run)
        try:
            yield run
            run.finished_at = utc_now()
            self.commit(replace(run, seq=1, status=SUCCESS))
        except Exception as error:
            run.error_msg = str(error)
            failed = replace(run, seq=1, finished_at=utc_now(), status=FAILED, last_keys={}, added=[], removed=[])
            self.append(failed)
            raise
        run.status = SUCCESS

    # --- questions ---------------------------------------------------------------------------------------

    def state(self) -> DataFrame:
        return ledger_state(self.events())

    def successes(self, job_name: str, source_name: str) -> DataFrame:
        return self.events().where(committed(job_name, source_name))

    def last_success(
        self, job_name: str, source_name: str, execution_date: date | None = None
    ):
        """The newest committed run, as a row of the ledger, or None."""
        runs = self.successes(job_name, source_name)
        if execution_date is not None:
            runs = runs.where(F.col("execution_date") == F.lit(execution_date))
        return runs.orderBy(F.desc("version"), F.desc("finished_at"), F.desc("run_id")).first()

    def batch_run(
        self, job_name: str, source_name: str, batch_id: int, stream_id: str | None
    ) -> str | None:
        """The committed run of a stream's micro-batch; another stream's batches do not count."""
        same = (F.col("batch_id") == batch_id) & F.col("stream_id").eqNullSafe(F.lit(stream_id))
        row = self.successes(job_name, source_name).where(same).select("run_id").first()
        return row["run_id"] if row else None

    def watermark(
        self, source_name: str, seed: datetime | None = WATERMARK_SEED
    ) -> datetime:
        """The source's high-water mark, to the microsecond."""
        found = self.view().ask(mark=newest_mark(source_name))["mark"]
        if found is not None:
            return found
        if seed is None:
            raise WatermarkMissing(f"no watermark for source {source_name!r}")
        return seed


@dataclass(frozen=True)
class LedgerView:
    """The log up to one version."""

    version: int
    events: DataFrame

    def ask(self, **answers: Column) -> Row:
        """Several aggregates of the events in one pass over them."""
        return self.events.agg(*[c.alias(n) for n, c in answers.items()]).first()

    def files(self, table: str) -> list[DataFile]:
        """The table's files: all that were added and not taken out again.

        The list is as long as a listing of the table's folders would be, and comes from the log alone; what was taken out
        before the last checkpoint is no longer in it.
        """

        def mine(column: str) -> Column:
            return F.coalesce(F.filter(column, lambda f: f["table"] == table), F.array())

        changes = self.events.where(F.col("status") == SUCCESS).select(mine("added").alias("new"), mine("removed").alias("old"))
        rows = changes.where((F.size("new") > 0) | (F.size("old") > 0)).collect()
        gone = {f["path"] for r in rows for f in r["old"]}
        live = (DataFile(**f.asDict()) for r in rows for f in r["new"] if f["path"] not in gone)
        return sorted(live, key=lambda f: f.path)


def _folded(events: DataFrame) -> DataFrame:
    """Events without the files that later ones took out, so that a long history of rewrites stays short.

    Only events that added files are joined with what is left of them; all others, which may be most, are not shuffled.
    """
    none = F.array().cast(T.ArrayType(DATA_FILE))
    adds = F.coalesce(F.size("added") > 0, F.lit(False))
    idle = events.where(~adds).withColumns({"added": none, "removed": none}).select(*SCHEMA.names)
    gone = events.select(F.explode("removed").alias("f")).select("f.table", "f.path")
    added = events.select("run_id", "seq", F.explode("added").alias("file"))
    live = added.join(gone, (F.col("file.table") == gone["table"]) & (F.col("file.path") == gone["path"]), "left_anti")
    kept = live.groupBy("run_id", "seq").agg(F.collect_list("file").alias("added"))
    loads = (
        events.where(adds)
        .drop("added", "removed")
        .join(kept, ["run_id", "seq"], "left")
        .withColumns({"added": F.coalesce("added", none), "removed": none})
        .select(*SCHEMA.names)
    )
    return idle.unionByName(loads)


def committed(job_name: str, source_name: str) -> Column:
    return (
        (F.col("status") == SUCCESS)
        & (F.col("job_name") == job_name)
        & (F.col("source_name") == source_name)
    )


def newest_mark(source_name: str) -> Column:
    """The high-water mark of a source, as an aggregate of events."""
    mine = (F.col("status") == SUCCESS) & (F.col("watermark_source") == source_name)
    return F.max(F.when(mine, F.col("watermark_end")))


def newest_run(job_name: str, source_name: str, execution_date: date, *columns: str) -> Column:
    """Columns of the newest committed run for a date, as an aggregate of events."""
    mine = committed(job_name, source_name) & (F.col("execution_date") == F.lit(execution_date))
    order = F.when(mine, F.struct("version", "finished_at", "run_id"))
    return F.max_by(F.struct(*columns), order)


def last_keys(tables: Iterable[str]) -> dict[str, Column]:
    """The highest surrogate key that committed runs gave out in each table, as aggregates of events."""
    done = F.col("status") == SUCCESS
    return {
        t: F.coalesce(F.max(F.when(done, F.try_element_at("last_keys", F.lit(t)))), F.lit(0)) for t in tables
    }


def ledger_state(events: DataFrame) -> DataFrame:
    """The current row of each run: its latest event."""
    rest = [c for c in events.columns if c not in ("run_id", "seq")]
    last = events.groupBy("run_id").agg(
        F.max_by(F.struct(*rest), "seq").alias("_last"), F.max("seq").cast("int").alias("seq")
    )
    return last.select("run_id", "seq", *[F.col(f"_last.{c}").alias(c) for c in rest])


def run_status(events: DataFrame, n: int = 20) -> DataFrame:
    """The latest ``n`` runs with their metrics."""
    return (
        ledger_state(events)
        .orderBy(F.desc("started_at"), "run_id")
        .limit(n)
    )


def watermark_state(events: DataFrame) -> DataFrame:
    """The high-water mark of each source, from committed loads only."""
    return (
        events.where(
            (F.col("status") == SUCCESS) & F.col("watermark_end").isNotNull()
        )
        .groupBy("watermark_source")
        .agg(
            F.max("watermark_end").alias("last_processed_ts"),
            F.max("finished_at").alias("updated_at"),
        )
    )


def seeded_watermarks(
    sources: DataFrame, events: DataFrame, seed: datetime = WATERMARK_SEED
) -> DataFrame:
    """Every source with its high-water mark, the seed where it has none."""
    return sources.join(
        watermark_state(events).select("watermark_source", "last_processed_ts"),
        F.col("source_name") == F.col("watermark_source"),
        "left",
    ).select(
        "source_name",
        F.coalesce("last_processed_ts", instant(seed)).alias("last_processed_ts"),
    )
