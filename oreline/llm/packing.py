"""Bounded-space online best-fit packing of documents into sequences.

Each task reads its documents once, in order, and keeps a fixed number of open sequences.
Their free spaces are the set bits of one integer: the best fit for a piece is the lowest
bit at or above its length.  When one more must be opened than allowed, the
fullest closes first.  Pieces come in runs of ``lookahead``, longest first in each run.  Nothing
is shuffled, and a task holds ``open_bins`` sequences, one run and its longest document at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from oreline.llm.tokens import encoder
from oreline.llm.words import tidied

PIECE = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, offset: bigint>"
SEQUENCE = f"sequence_id bigint, n_tokens int, ids array<int>, pieces array<{PIECE}>"
ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("ids", pa.list_(pa.int32())),
        (
            "pieces",
            pa.list_(
                pa.struct(
                    [
                        ("doc_id", pa.int64()),
                        ("piece", pa.int32()),
                        ("start", pa.int64()),
                        ("length", pa.int64()),
                        ("offset", pa.int64()),
                    ]
                )
            ),
        ),
    ]
)


@dataclass
class Sequence:
    used: int = 0
    pieces: list[tuple] = field(default_factory=list)
    #: Of each piece its ids, or what was made of them.
    kept: list = field(default_factory=list)

    def add(self, doc_id, piece: int, start: int, length: int, kept) -> None:
        self.pieces.append((doc_id, piece, start, length, self.used))
        self.kept.append(kept)
        self.used += length


class OpenBins:
    """At most ``limit`` open sequences, found by their free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_space: dict[int, list[Sequence]] = {}
        self.bits = 0
        self.count = 0

    def take(self, space: int) -> Sequence:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            del self.by_space[space]
            self.bits &= ~(1 << space)
        self.count -= 1
        return found

    def best_fit(self, length: int) -> Sequence:
        """The open sequence with the least space that is enough, or a new one."""
        fits = self.bits >> length
        if not fits:
            return Sequence()
        return self.take(length + (fits & -fits).bit_length() - 1)

    def put(self, bin: Sequence) -> Iterator[Sequence]:
        """Keep ``bin`` open; yields what closes for it."""
        space = self.capacity - bin.used
        if space == 0:
            yield bin
            return
        self.by_space.setdefault(space, []).append(bin)
        self.bits |= 1 << space
        self.count += 1
        if self.count > self.limit:
            yield self.take((self.bits & -self.bits).bit_length() - 1)

    def rest(self) -> Iterator[Sequence]:
        while self.bits:
            yield self.take((self.bits & -self.bits).bit_length() - 1)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for a shorter first."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(a, capacity) for a in range(head, n, capacity)]


@dataclass(frozen=True)
class Packing:
    """How documents are packed; see :func:`pack`."""

    tokenizer: str
    capacity: int = 2048
    end_id: int | None = 0
    open_bins: int = 1024
    lookahead: int = 1000
    emit: int = 256

    def closed(self, batches: Iterator[pa.RecordBatch], keep: Callable) -> Iterator[list[Sequence]]:
        """Lists of closed sequences; ``keep(ids)`` says what stays of each piece."""
        bins = OpenBins(self.capacity, self.open_bins)
        tail = np.array([] if self.end_id is None else [self.end_id], dtype="<u4")
        done: list[Sequence] = []
        run: list[tuple] = []

        def place() -> None:
            run.sort(key=lambda p: p[3], reverse=True)
            for piece in run:
                bin = bins.best_fit(piece[3])
                bin.add(*piece)
                done.extend(bins.put(bin))
            run.clear()

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at, counts, ids in encoder(self.tokenizer).encode(batch.column("text").to_pylist()):
                end = np.cumsum(counts)
                for i, (a, b) in enumerate(zip((end - counts).tolist(), end.tolist())):
                    whole = np.concatenate((ids[a:b], tail))
                    for piece, (start, n) in enumerate(cut(len(whole), self.capacity)):
                        run.append((keys[at + i], piece, start, n, keep(whole[start : start + n])))
                    if len(run) >= self.lookahead:
                        place()
                        if len(done) >= self.emit:
                            yield done
                            done = []
        place()
        for bin in bins.rest():
            done.append(bin)
            if len(done) >= self.emit:
                yield done
                done = []
        if done:
            yield done


def pack(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Sequences of at most ``capacity`` ids made of ``docs`` (doc_id, text; others ignored).

    ``how`` are fields of :class:`Packing`.  A null text is empty; ``end_id``, if given, closes each document.  Documents
    longer than a sequence are cut into full pieces after a shorter first one; no other is
    cut.  A document without any ids gives no piece.  Rows may repeat; an empty table gives no rows.
    Numbers of sequences are unique, and the same whenever a task is run again.
    """
    packing = Packing(tokenizer, **how)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        names = ("doc_id", "piece", "start", "length", "offset")
        # copies, so that an open sequence does not hold whole documents
        for closed in packing.closed(batches, np.ndarray.copy):
            counts = np.array([s.used for s in closed], dtype=np.int32)
            flat = np.concatenate([i for s in closed for i in s.kept]).astype(np.int32)
            edges = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + len(closed), dtype=np.int64)),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
                    pa.array(
                        [[dict(zip(names, p)) for p in s.pieces] for s in closed],
                        type=ARROW.field("pieces").type,
                    ),
                ],
                schema=ARROW,
            )
            number += len(closed)

    return docs.select("doc_id", "text").mapInArrow(tidied(sequences), SEQUENCE)


def pack_digests(docs: DataFrame, tokenizer: str, digest: Callable[[np.ndarray], int], name: str, **how) -> DataFrame:
    """The same packing as one row per piece, with a whole number made of its ids in place of the ids.

    Returns doc_id, piece, start, length, offset, sequence_id and ``name``; the ids never leave the task.
    """
    packing = Packing(tokenizer, **how)
    names = ["doc_id", "piece", "start", "length", "offset", "sequence_id", name]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for closed in packing.closed(batches, digest):
            rows = [
                (*piece, number + i, kept) for i, s in enumerate(closed) for piece, kept in zip(s.pieces, s.kept)
            ]
            number += len(closed)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

    ddl = ", ".join(f"{n} {'int' if n == 'piece' else 'bigint'}" for n in names)
    return docs.select("doc_id", "text").mapInArrow(tidied(pieces), ddl)
