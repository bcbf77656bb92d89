"""Scans of landed text files and partitioned Parquet tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.contract import Contract

# Encoding names that mean UTF-8 with a byte-order mark.
BOM_ENCODINGS = ("utf-8-sig", "utf-8-bom")
BOM = "﻿"


def spark_encoding(encoding: str) -> str:
    return "UTF-8" if encoding.lower() in BOM_ENCODINGS else encoding


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    headers: Sequence[str] | None = None,
    infer_schema: bool = False,
) -> DataFrame:
    """A headered CSV source; all columns are text unless inference is asked for.

    ``headers`` names the file's columns in file order, which saves the job that
    reads the header line.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("encoding", spark_encoding(encoding))
        .option("inferSchema", infer_schema)
    )
    if headers is not None:
        # A file whose header differs is an error, not a silent misread.
        reader = reader.schema(text_schema(headers)).option("enforceSchema", False)
    df = reader.csv(path)
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


#: Headers that the files of one source may have between them.
HEADERS = 100


def header_of(spark: SparkSession, uri: str, encoding: str) -> str | None:
    """The first line of a text file, unpacked if its name says so; None if it is empty.

    A header with a line break in a quoted name is not supported.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        opened = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, spark_encoding(encoding))).readLine()
    finally:
        stream.close()
    return line.lstrip(BOM) if line is not None else None


def read_csv_by_header(
    spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """Headered CSV files whose columns may differ in order, or be missing in some; all columns are text.

    The driver reads one line of each file that it has listed.  Files with the same header are one scan, checked against it, and the
    scans are put together by name; a column that a file lacks is null there.
    """
    by_header: dict[str, list[str]] = {}
    for uri in spark.read.text(path).inputFiles():
        header = header_of(spark, uri, encoding)
        if header is not None:
            file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
            by_header.setdefault(header, []).append(file)
    if len(by_header) < 2:
        return read_csv(spark, path, delimiter, encoding)
    if len(by_header) > HEADERS:
        raise ValueError(f"the files of {path} have {len(by_header)} different headers")
    frames = []
    for header in sorted(by_header):
        names = next(csv.reader([header], delimiter=delimiter))
        frames.append(read_csv(spark, by_header[header], delimiter, encoding, headers=names))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_source(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """The contract's source, in the format it declares."""
    if contract.file_format == "csv":
        return read_csv_by_header(spark, path, contract.delimiter, contract.encoding)
    if contract.file_format == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(text_schema(contract.raw_headers)).json(path)


def on_day(df: DataFrame, day: date) -> DataFrame:
    """Partition filter; partition values may have been read as text or numbers."""
    return df.where(
        (F.col("year").cast("int") == day.year)
        & (F.col("month").cast("int") == day.month)
        & (F.col("day").cast("int") == day.day)
    )


def day_folder(base: str, day: date) -> str:
    return f"{base}/year={day:%Y}/month={day:%m}/day={day:%d}"


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType, infer: bool = False
) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing was written yet.

    With ``infer`` the files' own schema counts, and ``schema`` is only the fallback.
    """
    reader = spark.read if infer else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed_files(spark: SparkSession, base: str) -> DataFrame:
    """One row per landed file, with its partition values.  No content is read.

    Where nothing has landed yet there are no rows, and no partition columns.
    """
    try:
        return spark.read.format("binaryFile").load(base).drop("content")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [], "path string, modificationTime timestamp, length bigint"
        )


def arrival_audit(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected (source, year, month, day) rows for which no file has landed."""
    key = ["source_name", "year", "month", "day"]
    if not set(key) <= set(landed.columns):
        return expected
    return expected.join(landed.select(*key).distinct(), key, "left_anti")
