"""Session defaults, the shared working folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An extra exchange is cheaper than one task holding a hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Text shrinks to a fraction as Parquet; larger splits make files worth reading.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Longer generated methods are not compiled by the JVM; wide contracts reach that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    # A few open partition files per task spare the sort of a write by outcome.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(
    app_name: str = "oreline",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings, functions and views of another; what is set in it holds for its own queries alone."""
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


#: Defaults without which judging a wide contract and writing it by outcome cost several times as much.
_JUDGING = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters")


def fill_defaults(spark: SparkSession, names: Sequence[str] = _JUDGING) -> None:
    """Give a session that others built the named defaults; what it sets itself stays."""
    for name in names:
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, DEFAULTS[name])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder that lives as long as the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="oreline-")
    return _local_folders[app].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; no two calls return the same."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str = "cut", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` once and go on from the files.

    Used where a frame feeds several branches, or must not be recomputed: the
    written files outlive the executors that made them, and later reads prune
    columns, and folders where ``partition_by`` made some.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(as_nullable(df.schema)).parquet(path).select(*df.columns)


def discard(df: DataFrame) -> None:
    """Remove the files of a materialised frame that nothing will read again, to free the shared folder."""
    spark = df.sparkSession
    root = shared_folder(spark)
    for folder in {unquote(file).rsplit("/", 1)[0] for file in df.inputFiles()}:
        if root.split(":", 1)[-1].rstrip("/") not in folder:
            raise ValueError(f"{folder} is not below the shared folder")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def as_nullable(schema: T.StructType) -> T.StructType:
    """File sources report every column nullable; say so up front."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
