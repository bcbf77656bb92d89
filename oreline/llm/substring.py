"""Removes repeated passages: seed and extend.

1. Seeds.  A window is ``length`` words.  Its anchor is the run of ``k`` words in it with the least hash
   (the rightmost of equals), as in winnowing, so equal windows have equal anchors in equal
   places.  The windows in a row that share an anchor are a seed: the anchor, extended to both sides as
   far as it serves.  A document has about one seed per (length - k + 2) / 2 words.
2. Join.  Anchors that several documents hold are found by their smallest and largest doc_id, which combine before they are shuffled;
   only seeds at such anchors travel, and of equal seeds in one batch only the smallest document's.  A seed that occurs
   whole in a smaller document is repeated, with all its windows.
3. Extend.  Where different seeds share an anchor, the match ends somewhere within them: the first holder of each such seed is
   extended word by word, one window for every way of sharing ``length`` words between left and right of the anchor, and the smallest
   document of each window is found.  (The first holder of a window never holds it in a seed that a
   still smaller document holds whole, so nothing else has to be looked at.)
4. Repeats.  Repeated seeds and windows merge into maximal spans.

No window or group holds the rows of one anchor or passage together: all counting is by aggregates, and hot keys
of the joins are split by adaptive execution.  Rows are told apart by doc_id and a hash of the text, so rows that share a doc_id do not mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.words import Words, kept_text, mix, run_hashes, span_hashes, words
from oreline.session import materialize

#: Rows in a batch that goes back to Spark.
ROWS = 1 << 17


def anchors(group: Words, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, anchor, hash): for each window's first word, its anchor's word and hash."""
    windows = group.runs(length)
    if not len(windows):
        return windows, windows, np.empty(0, dtype=np.uint64)
    h = run_hashes(group.hash, np.arange(len(group.hash) - k + 1), k)
    best, at = h[windows].copy(), windows.copy()
    for j in range(1, length - k + 1):
        other = h[windows + j]
        less = other <= best
        best[less] = other[less]
        at[less] = windows[less] + j
    return windows, at, best


def _batch_seeds(batch: pa.RecordBatch, length: int, k: int) -> tuple[np.ndarray, ...] | None:
    """(anchor, seed, doc_id, part, start, n) of a batch, by anchor, seed and doc_id."""
    ids, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "part"))
    parts = []
    for group in words(batch.column("text")):
        window, at, h = anchors(group, length, k)
        if not len(window):
            continue
        new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        n = np.diff(np.append(new, len(window)))
        first = window[new]
        row = group.row[first]
        whole = span_hashes(group.hash, first, first + n - 1 + length)
        own = group.first_row + row
        parts.append((h[new], whole, ids[own], part[own], first - group.bounds()[row], n))
    if not parts:
        return None
    found = [np.concatenate(p) for p in zip(*parts)]
    order = np.lexsort((found[2], found[1], found[0]))
    return tuple(x[order] for x in found)


def shared_anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor, several): anchors that more than one document holds, and whether in different seeds."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_seeds(batch, length, k)
            if found is None:
                continue
            anchor, seed, doc = (x.view(np.int64) for x in found[:3])
            at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            columns = [anchor[at]] + [f.reduceat(x, at) for x in (seed, doc) for f in (np.minimum, np.maximum)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=RANGES)

    ranges = docs.mapInArrow(make, ", ".join(f"{c} bigint" for c in RANGES))
    return (
        ranges.groupBy("anchor")
        .agg(*[f(c).alias(c) for c, f in zip(RANGES[1:], (F.min, F.max, F.min, F.max))])
        .where("first_doc < last_doc")
        .select("anchor", F.expr("least_seed < most_seed").alias("several"))
    )


RANGES = ("anchor", "least_seed", "most_seed", "first_doc", "last_doc")


def seeds(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor, seed, doc_id, part, start, n, done): runs of ``n`` windows from word ``start``.

    ``done`` marks what a smaller document of the same batch holds as well.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_seeds(batch, length, k)
            if found is None:
                continue
            anchor, seed, doc, part, start, n = found
            fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (seed[1:] != seed[:-1]))
            done = doc > doc[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            columns = [anchor.view(np.int64), seed.view(np.int64), doc, part, start, n.astype(np.int32), done]
            for a in range(0, len(done), ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[a : a + ROWS]) for c in columns],
                    names=["anchor", "seed", "doc_id", "part", "start", "n", "done"],
                )

    return docs.mapInArrow(
        make, "anchor bigint, seed bigint, doc_id bigint, part bigint, start bigint, n int, done boolean"
    )


def extended(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, part, start, w1, w2): the windows of the seeds of ``docs`` (doc_id, part, text, seeds)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "part"))
            lists = batch.column("seeds")
            for group in words(batch.column("text")):
                own = lists.slice(group.first_row, group.n_rows)
                row = np.repeat(np.arange(group.n_rows), pc.list_value_length(own).to_numpy())
                flat = own.flatten()
                start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
                start = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                at = start + group.bounds()[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[group.first_row + row], type=pa.int64()),
                        pa.array(part[group.first_row + row], type=pa.int64()),
                        pa.array(start),
                        pa.array(run_hashes(group.hash, at, length).view(np.int64)),
                        pa.array(run_hashes(mix(~group.hash), at, length).view(np.int64)),
                    ],
                    names=["doc_id", "part", "start", "w1", "w2"],
                )

    return docs.select("doc_id", "part", "text", "seeds").mapInArrow(
        make, "doc_id bigint, part bigint, start bigint, w1 bigint, w2 bigint"
    )


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text): ``part`` tells rows that share a doc_id apart by their texts."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("part"), "text")


def repeated_parts(docs: DataFrame, length: int = 13, k: int = 4) -> DataFrame:
    """(doc_id, part, low, high): runs of words that also occur in a smaller document; they may overlap.

    Words are what lies between ``[\\x20\\x09-\\x0D]``, unchanged.  ``part`` is the row's hash of its text.
    """
    known = _rows(docs).where("doc_id is not null")
    shared = materialize(shared_anchors(known, length, k), "anchors")
    found = materialize(
        seeds(known, length, k).join(shared, "anchor").select("*"),
        "seeds",
    )
    apart = found.where("not done")
    owners = (
        apart.groupBy(F.col("anchor").alias("_anchor"), F.col("seed").alias("_seed"))
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last")
    )
    owned = apart.join(owners, (F.col("anchor") == F.col("_anchor")) & (F.col("seed") == F.col("_seed")), "left")
    marks = materialize(
        owned.withColumn("whole", F.coalesce(F.col("owner") < F.col("doc_id"), F.lit(False)))
        .where("whole or several")
        .select("doc_id", "part", "start", "n", "whole"),
        "marks",
    )
    partly = (
        marks.where("not whole")
        .groupBy("doc_id", "part")
        .agg(F.collect_set(F.struct("start", "n")).alias("seeds"))
    )
    windows = materialize(extended(known.join(partly, ["doc_id", "part"]), length), "windows")
    firsts = materialize(
        windows.groupBy(F.col("w1").alias("_w1"), F.col("w2").alias("_w2"))
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last")
        .select("_w1", "_w2", "owner"),
        "owners",
    )
    single = windows.join(firsts, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2"))).where(
        F.col("doc_id") > F.col("owner")
    )
    end = (F.col("start") + F.col("n") - 1 + length).alias("high")
    return (
        marks.where("whole")
        .select("doc_id", "part", F.col("start").alias("low"), end)
        .union(found.where("done").select("doc_id", "part", "start", end))
        .union(single.select("doc_id", "part", "start", F.col("start") + length))
    )


def remove_repeats(docs: DataFrame, length: int = 13, k: int = 4) -> DataFrame:
    """``docs`` with repeated passages taken out: doc_id, n_words, n_removed, kept_text, spans.

    ``kept_text`` is the words that stay, joined by one space.  Of the documents that hold a window
    of ``length`` words, the smallest doc_id keeps it; windows are judged on the input.  Texts that are null or have
    no words give 0 words and an empty text.  Rows that share a doc_id are judged one by one, by the smaller ids only;
    a row without a doc_id keeps its words.  Other columns are left out.
    """
    parts = (
        repeated_parts(docs, length, k)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("part").alias("_part"))
        .agg(F.collect_set(F.struct("low", "high")).alias("parts"))
    )
    placed = (
        _rows(docs)
        .join(parts, (F.col("doc_id") == F.col("_doc")) & (F.col("part") == F.col("_part")), "left")
        .select("doc_id", "text", "parts")
    )

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.fill_null(batch.column("parts"), [])
            for group in words(batch.column("text")):
                own = lists.slice(group.first_row, group.n_rows)
                bounds, flat = group.bounds(), own.flatten()
                first = bounds[np.repeat(np.arange(group.n_rows), pc.list_value_length(own).to_numpy())]
                change = np.zeros(len(group.row) + 1, dtype=np.int64)
                np.add.at(change, first + flat.field("low").to_numpy(), 1)
                np.add.at(change, first + flat.field("high").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                low, high = _stretches(gone, group.row)
                upto = np.searchsorted(low, bounds).astype(np.int32)
                row = group.row[low]
                spans = pa.ListArray.from_arrays(
                    pa.array(upto),
                    pa.StructArray.from_arrays(
                        [pa.array(low - bounds[row]), pa.array(high - bounds[row])], names=["low", "high"]
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(group.first_row, group.n_rows),
                        pa.array(np.diff(bounds)),
                        pa.array(np.bincount(group.row[gone], minlength=group.n_rows)),
                        kept_text(group, ~gone),
                        spans,
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "spans"],
                )

    return placed.mapInArrow(
        strip,
        "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, "
        "spans array<struct<low: bigint, high: bigint>>",
    )


def _stretches(marked: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the maximal runs of marked words within a row."""
    new = np.append(True, row[1:] != row[:-1])[: len(row)]
    before = np.append(False, marked[:-1])[: len(row)] & ~new
    after = np.append(marked[1:] & ~new[1:], False)[: len(row)]
    return np.flatnonzero(marked & ~before), np.flatnonzero(marked & ~after) + 1
