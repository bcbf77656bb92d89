"""Drops lines that many documents hold, keeping them in one; DataFrame functions only.

Lines are exploded and keyed by a 128-bit hash of their normalised form; an aggregation that
combines before it shuffles counts the documents of each key; lines of frequent keys are
found by a join that adaptive execution splits where a line is hot; and documents are put
together again from the positions that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.session import materialize

#: What the key leaves out at both ends of a line.
EDGES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(EDGES)), UPPER, LOWER)


def deduplicate_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` (doc_id, text, others) with frequent lines dropped.

    A line is dropped if its key has ``min_chars`` code points or more, ``min_docs`` documents or
    more hold that key, and the document is not the one with the largest doc_id of these, which keeps
    all its lines.  Adds ``n_lines``, ``n_dropped`` and ``kept_text``, in place of columns of these names; others stay as they are.

    A null text counts as one empty line, and ``kept_text`` is then empty.  Rows
    that share a doc_id count as one document, and each of them loses its own lines; a row without a doc_id keeps all its lines
    and is not counted.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    # Rows that share a doc_id are told apart by their texts, as positions belong to one text.
    part = F.xxhash64("text")
    # Distinct keys of each document, so that a line repeated in it counts once.
    keys = F.array_distinct(
        F.transform(
            F.filter(F.transform(lines, line_key), lambda k: F.char_length(k) >= min_chars),
            lambda k: F.struct(
                F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("second"), k).alias("h2")
            ),
        )
    )
    frequent = materialize(
        docs.where("doc_id is not null")
        .select("doc_id", F.explode(keys).alias("key"))
        .select("doc_id", "key.h1", "key.h2")
        .distinct()  # rows may share a doc_id
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper"),
        "frequent-lines",
    )
    placed = (
        docs.where("doc_id is not null")
        .select("doc_id", part.alias("part"), F.posexplode(F.transform(lines, line_key)).alias("pos", "k"))
        .where(F.char_length("k") >= min_chars)
        .select(
            "doc_id",
            "part",
            "pos",
            F.xxhash64("k").alias("h1"),
            F.xxhash64(F.lit("second"), "k").alias("h2"),
        )
    )
    dropped = (
        placed.join(frequent, ["h1", "h2"])
        .where(F.col("doc_id") < F.col("keeper"))
        .groupBy(F.col("doc_id").alias("_doc"), F.col("part").alias("_its"))
        .agg(F.collect_set("pos").alias("_dropped"))
    )
    # Lines are split below the join, so that no text is split once per line above it.  The row travels packed, so that
    # no name of it can clash.
    parts = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("_id"), part.alias("_part"), lines.alias("_lines")
    )
    joined = parts.join(dropped, (F.col("_id") == F.col("_doc")) & (F.col("_part") == F.col("_its")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    new = {
        "n_lines": F.size("_lines").cast("long"),
        "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"),
        "kept_text": F.when(F.col("_dropped").isNull(), F.coalesce(F.col("row")["text"], F.lit(""))).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
        ),
    }
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in new]
    # In two steps: beside each other, names of the input could stand for those used here.
    return joined.select("row", *[c.alias(n) for n, c in new.items()]).select(*others, *new)


SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS gone
  FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
