"""Token ids in directly addressable codes.

An id is split into 8-bit chunks, lowest first.  Level 0 holds the first chunk of every
id; a bitmap marks the ids that go on, and level 1 holds the second chunk of those only;
and so on.  A rank directory counts the marks before every 512th bit, so the chunk of any
id at the next level is found by one directory entry and at most eight words of the
bitmap: no block has to be decoded to read one token.

The format: Parquet rows of one *segment* each, written and read by Spark.

=============  ================================================================
shard          range of doc_id, ascending; at most as many as ``shards``
segment        position in the shard
before         ids of the shard before this segment
n_tokens       ids in the segment
doc_ids        documents, ascending (nulls first; equal ids by text)
doc_starts     where each begins in the segment
levels         array of (chunks, marks, ranks): bytes, little-endian bitmap and uint32
=============  ================================================================

A document is never cut, so a segment holds ``segment_tokens`` ids or one document more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreline.llm.tokens import encoder
from oreline.llm.words import tidied
from oreline.session import shuffle_partitions

RANK_BITS = 512
LEVEL = "struct<chunks: binary, marks: binary, ranks: binary>"
SEGMENT = (
    "shard int, segment int, before bigint, n_tokens bigint, "
    f"doc_ids array<bigint>, doc_starts array<bigint>, levels array<{LEVEL}>"
)
ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
        (
            "levels",
            pa.list_(
                pa.struct(
                    [("chunks", pa.binary()), ("marks", pa.binary()), ("ranks", pa.binary())]
                )
            ),
        ),
    ]
)


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        words = -(-len(rest) // RANK_BITS) * (RANK_BITS // 8)
        marks = np.zeros(words, dtype=np.uint8)
        packed = np.packbits(more, bitorder="little")
        marks[: len(packed)] = packed
        blocks = np.bitwise_count(marks.view("<u8")).reshape(-1, RANK_BITS // 64)
        per_block = blocks.sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(per_block, dtype=np.uint32) - per_block).astype("<u4")
        levels.append(
            {
                "chunks": (rest & 0xFF).astype(np.uint8).tobytes(),
                "marks": marks.tobytes(),
                "ranks": ranks.tobytes(),
            }
        )
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return levels


class Codes:
    """Reads one segment's levels."""

    def __init__(self, levels: list[dict[str, bytes]]):
        self.levels = [
            (
                np.frombuffer(v["chunks"], dtype=np.uint8),
                np.frombuffer(v["marks"], dtype="<u8"),
                np.frombuffer(v["ranks"], dtype="<u4"),
            )
            for v in levels
        ]

    @staticmethod
    def _rank(marks: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Marks before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        count = ranks[at >> 9].astype(np.int64) + np.bitwise_count(marks[word] & low)
        begin = (at >> 9) << 3
        for j in range(RANK_BITS // 64 - 1):
            inner = begin + j
            count += np.where(inner < word, np.bitwise_count(marks[inner]), 0)
        return count

    def at(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, in any order."""
        positions = np.asarray(positions, dtype=np.int64)
        ids = np.zeros(len(positions), dtype=np.uint32)
        going = np.arange(len(positions))
        for k, (chunks, marks, ranks) in enumerate(self.levels):
            ids[going] |= chunks[positions].astype(np.uint32) << np.uint32(8 * k)
            bit = (marks[positions >> 6] >> (positions & 63).astype(np.uint64)) & np.uint64(1)
            on = bit == 1
            going = going[on]
            if not len(going):
                break
            positions = self._rank(marks, ranks, positions[on])
        return ids

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` consecutive ids: one rank per level, then the bits in between."""
        ids, where = np.zeros(n, dtype="<u4"), None
        for k, (chunks, marks, ranks) in enumerate(self.levels):
            if n == 0:
                break
            part = chunks[start : start + n].astype(np.uint32) << np.uint32(8 * k)
            if where is None:
                ids[:] = part
            else:
                ids[where] |= part
            bytes_ = marks.view(np.uint8)[start >> 3 : (start + n + 7) >> 3]
            bits = np.unpackbits(bytes_, bitorder="little")[start & 7 :][:n]
            on = np.flatnonzero(bits)
            where = on if where is None else where[on]
            start = int(self._rank(marks, ranks, np.array([start]))[0])
            n = len(on)
        return ids


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    shards: int | None = None,
    segment_tokens: int = 1 << 20,
) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) into a store at ``path``.

    A null text is empty; ``end_id``, if given, follows every document.  A table without
    rows gives a store without segments.  Memory per task: one segment, or the longest document.
    """
    spark = docs.sparkSession
    shards = shards or max(1, shuffle_partitions(spark))
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        kept: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        starts: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(kept) if kept else np.empty(0, dtype=np.uint32)
            row = {
                "shard": shard,
                "segment": number,
                "before": before,
                "n_tokens": len(ids),
                "doc_ids": doc_ids,
                "doc_starts": starts,
                "levels": encode_levels(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        tail = np.array([] if end_id is None else [end_id], dtype="<u4")
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at, counts, ids in encoder(tokenizer).encode(batch.column("text").to_pylist()):
                end = np.cumsum(counts)
                for i, (a, b) in enumerate(zip(end - counts, end)):
                    doc_ids.append(keys[at + i])
                    starts.append(held)
                    kept += [ids[a:b], tail]
                    held += int(b - a) + len(tail)
                    if held >= segment_tokens:
                        yield flush()
                        number, before, held = number + 1, before + held, 0
                        kept, doc_ids, starts = [], [], []
        if doc_ids:
            yield flush()

    ordered.mapInArrow(tidied(segments), SEGMENT).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def shard_starts(store: DataFrame) -> DataFrame:
    """(shard, base): ids in all shards before; one row per shard, a bounded number."""
    sizes = store.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_documents(store: DataFrame, summarise, columns: dict[str, str]) -> DataFrame:
    """Reads every document back; ``summarise(ids)`` gives the tuple of what is wanted.

    Returns doc_id, start (ids of all documents before), n_tokens and ``columns`` (name: type).
    """
    out = {"shard": "int", "doc_id": "bigint", "at": "bigint", "n_tokens": "bigint", **columns}
    names = list(out)
    ddl = ", ".join(f"{n} {t}" for n, t in out.items())

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["levels"])
                ends = [*row["doc_starts"][1:], row["n_tokens"]]
                rows = []
                for doc, a, b in zip(row["doc_ids"], row["doc_starts"], ends):
                    head = (row["shard"], doc, row["before"] + a, b - a)
                    rows.append(head + tuple(summarise(codes.read(a, b - a))))
                columns = [pa.array(list(c)) for c in zip(*rows)]
                columns[1] = columns[1].cast(pa.int64())
                columns[0] = columns[0].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    read = store.select("shard", "before", "n_tokens", "doc_ids", "doc_starts", "levels")
    # Bounded: one row per shard, and the writer was given their number.
    bases = F.broadcast(shard_starts(store))
    return (
        read.mapInArrow(documents, ddl)
        .join(bases, "shard")
        .select(
            "doc_id",
            (F.col("base") + F.col("at")).alias("start"),
            "n_tokens",
            *columns,
        )
    )


def lookup(store: DataFrame, requests: DataFrame, slice_tokens: int = 1 << 16) -> DataFrame:
    """The ids at (doc_id, position) of ``requests``, without decoding anything else.

    Positions that a document does not have, and null ids, give no row; repeated requests give
    one row each.  Documents stored twice under one id answer from each copy.
    """
    docs = store.select(
        "shard",
        "segment",
        F.posexplode("doc_ids").alias("i", "doc_id"),
        F.col("doc_starts"),
        "n_tokens",
    ).select(
        "shard",
        "segment",
        "doc_id",
        F.col("doc_starts")[F.col("i")].alias("a"),
        F.coalesce(F.get("doc_starts", F.col("i") + 1), "n_tokens").alias("b"),
    )
    placed = (
        requests.select("doc_id", F.col("position").cast("long").alias("position"))
        .join(docs, "doc_id")
        .where((F.col("position") >= 0) & (F.col("position") < F.col("b") - F.col("a")))
        .select("shard", "segment", "doc_id", "position", (F.col("a") + F.col("position")).alias("at"))
    )
    # A slice holds each position once, so no array outgrows ``slice_tokens``.
    slices = placed.groupBy(
        "shard", "segment", F.floor(F.col("at") / slice_tokens).alias("slice")
    ).agg(F.collect_set("at").alias("ats"))
    names = ["shard", "segment", "at", "token"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Codes(row["levels"]).at(np.array(row["ats"]))
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["shard"], dtype=np.int32)),
                        pa.array(np.full(n, row["segment"], dtype=np.int32)),
                        pa.array(row["ats"], type=pa.int64()),
                        pa.array(ids.astype(np.int64)),
                    ],
                    names=names,
                )

    found = (
        slices.join(store.select("shard", "segment", "levels"), ["shard", "segment"])
        .select("shard", "segment", "ats", "levels")
        .mapInArrow(read, "shard int, segment int, at bigint, token bigint")
    )
    return placed.join(found, ["shard", "segment", "at"]).select("doc_id", "position", "token")
