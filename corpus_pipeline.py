"""A corpus made ready for training: five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  Stages are written as
Parquet below the shared folder and read again, so a lost executor costs tasks, not stages.
All but the last return the columns of ``documents``.

* ``language_id`` learns from the rows with a ``lang`` and rejects documents in which no language is found (null texts, or no
  letter).
* ``line_dedup`` drops lines of 40 code points that 5 documents hold, but for the largest doc_id; a changed text
  gets a new ``n_chars``, and a document that loses all its lines stays with an empty text.
* ``near_dedup`` keeps the smallest doc_id of each group linked by 80 % of its five-word shingles.
* ``decontamination`` rejects documents that hold a passage of an item of ``benchmark``.
* ``packing`` returns sequences of at most 2048 tokens and the pieces of documents in them.

Rows that share a doc_id, or have none, are told apart by a number of their own where documents are compared, so of equal rows
one stays and each row is searched; ``line_dedup`` counts them as one document, and not at all. An empty table gives no
sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import decontaminate, langid, line_dedup, near_dedup, packing
from oreline.llm.queries import table, tokenizer_path
from oreline.llm.ship import ship_package
from oreline.operators.keys import dense_keys
from oreline.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return langid.identified(docs, langid.fit(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    # The row travels packed, so that the operator's new columns cannot clash with any of its names.
    judged = line_dedup.deduplicate_lines(docs.select("doc_id", "text", F.struct("*").alias("document")))
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    old = {c: F.col("document")[c] for c in docs.columns}
    return judged.select(
        F.struct(*[(F.when(changed, new[c]).otherwise(old[c]) if c in new else old[c]).alias(c) for c in docs.columns]).alias("d")
    ).select("d.*")


def numbered(docs: DataFrame) -> DataFrame:
    """(row_id, text, document): each row under a number that orders rows as their doc_id does, those without one last.

    The doc_id itself serves where it is unique, which one pass over that column tells.
    """
    counts = docs.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    packed = docs.select(F.col("doc_id").cast("bigint").alias("row_id"), "text", F.struct("*").alias("document"))
    if len(set(counts)) == 1:
        return packed
    ordered = packed.select(
        "text", "document", F.col("row_id").isNull().alias("lone"), F.col("row_id").alias("at"), F.xxhash64("text").alias("print")
    )
    return dense_keys(ordered, "row_id", ["lone", "at", "print"]).select("row_id", "text", "document")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = numbered(docs)
    groups = near_dedup.near_duplicates(rows.select(F.col("row_id").alias("doc_id"), "text"))
    gone = groups.where("not kept").select(F.col("doc_id").alias("row_id")).distinct()
    return rows.join(gone, "row_id", "left_anti").select("document.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = numbered(docs)
    found = decontaminate.find_passages(
        rows.select(F.col("row_id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    gone = found.select(F.col("doc_id").alias("row_id")).distinct()
    return rows.join(gone, "row_id", "left_anti").select("document.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Models, signatures and a tokenizer: tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
