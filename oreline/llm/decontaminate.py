"""Finds passages of benchmark items in documents: SimHash of item-sized windows.

1. Items and documents are words: lower case, letters and digits only.  A window has as many words as
   an item; a document with fewer is one window as a whole, for each size whose items it can be similar to.  Shingles
   are ``k`` words; an item with fewer words is one shingle as a whole, and so are the windows of its size.
2. A window reaches the similarity only if enough of its shingles are shingles of items of its size; bitmaps
   sized for the items, and filled by all of them, count them and can only err towards keeping a window.
3. Windows and items get a 64-bit SimHash over their words.  The fingerprint is cut into
   ``radius // 3 + 1`` blocks: two within ``radius`` bits differ by at most ``FLIPS`` bits in at least one.  Items give
   all values so near to each of their blocks, so a join on (size, block, value) finds all of them.  Blocks alone are
   too short to tell random pairs apart, so the join is also on a shingle: of two that are similar, the
   first few shingles in the order of their hashes have one in common.
4. Candidates within the radius are verified by the weighted similarity of their shingles: the sum of the
   lesser counts over the sum of the larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.words import SMALL_GROUP, SYMBOLS, Words, mix, run_hashes, tidied, words
from oreline.session import materialize

#: Bits of a bitmap of shingles, as powers of two: at least, at most (16 MB), and for each shingle.
LEAST_BITS, MOST_BITS, EACH_BITS = 16, 27, 5
#: Words between the first and last window whose fingerprints are made at once.
STRETCH = 1 << 14
#: Bits by which the nearest of ``radius // 3 + 1`` blocks may differ: ``radius // blocks`` is 2 at most.
FLIPS = 2
#: ``size`` is the words of the items to compare with, ``n_words`` those of the window or item itself.
#: ``first`` are the shingles of which similar windows and items share one.
SCHEMA = (
    "id bigint, start bigint, size bigint, n_words bigint, print bigint, shingles array<bigint>, first array<bigint>"
)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def simhash(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The 64-bit SimHash of ``n`` words from each start, in order: a bit is the majority of its words' bits."""
    cuts = np.flatnonzero(np.diff((starts - starts[0]) // STRETCH)) + 1
    return np.concatenate([_simhash(hashes, s, n) for s in np.split(starts, cuts)])


def _simhash(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    low = starts[0]
    part = mix(hashes[low : starts[-1] + n] ^ np.uint64(0x2545F4914F6CDD1D))
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(part) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    ones = total[starts - low + n] - total[starts - low]
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view(np.uint64).ravel()


def leading(shingles: np.ndarray, shared: int) -> list[int]:
    """Of some shingles those of which another list that shares ``shared`` with them has one among its own leading ones.

    Repeats count as shingles of their own.
    """
    order = np.argsort(shingles, kind="stable")
    h = shingles[order]
    new = np.append(True, h[1:] != h[:-1])
    again = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    elements = np.sort(mix(h + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return elements[: len(h) - shared + 1].view(np.int64).tolist()


def item_prints(items: DataFrame, k: int, percent: int) -> DataFrame:
    """Items (item_id, text) with words as SCHEMA; shingles with repeats, in order."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for group in words(lowered(batch.column("text")), SYMBOLS, size=SMALL_GROUP):
                bounds = group.bounds()
                rows = []
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if b > a:
                        n = int(b - a)
                        of = min(k, n)
                        shingles = run_hashes(group.hash, np.arange(a, b - of + 1), of)
                        print_ = simhash(group.hash, np.array([a]), n).view(np.int64)[0]
                        # what the shortest window that can be similar has to share
                        least = -(-len(shingles) * percent // 100)
                        rows.append(
                            (ids[group.first_row + i], 0, n, n, int(print_), shingles.view(np.int64).tolist(),
                             leading(shingles, least))
                        )
                yield _batch(rows)

    return items.where("item_id is not null").select("item_id", "text").mapInArrow(tidied(make), SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (*[pa.int64()] * 5, *[pa.list_(pa.int64())] * 2)
    names = ("id", "start", "size", "n_words", "print", "shingles", "first")
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names=names
    )


def _slots(shingles: np.ndarray, bits: int, size: int = 0) -> np.ndarray:
    """Where a shingle stands in the bitmap, by itself or among items of one size."""
    h = mix(shingles + np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (h >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Maps:
    """Bitmaps of the shingles of all items, and by item size; and the sizes."""

    bits: int
    any_size: np.ndarray
    by_size: np.ndarray
    sizes: list[int]


def bitmaps(prints: DataFrame) -> Maps:
    """Words of set bits are combined in Spark; 2**22 of them at most come to the driver for each map,
    and the sizes are no more than the words of the longest item."""
    shingles = prints.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, shingles.bit_length() + EACH_BITS))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, s in zip(batch.column("n_words").to_pylist(), batch.column("shingles")):
                h = s.values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.concatenate((_slots(h, bits), _slots(h, bits, n) + (1 << bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["word", "bit"]
                )

    found = (
        prints.select("n_words", "shingles")
        .mapInArrow(tidied(make), "word bigint, bit bigint")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    flat = np.zeros(2 << (bits - 5), dtype=np.uint32)
    flat[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    half = len(flat) // 2
    sizes = [r[0] for r in prints.select("n_words").distinct().collect()]
    return Maps(bits, flat[:half], flat[half:], sorted(sizes))


def _has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1) == 1


def needed(m: int, n: int, percent: int) -> int:
    """The least shingles sequences of ``m`` and ``n`` must share: inter >= percent% of (m + n - inter)."""
    return -(-(m + n) * percent // (100 + percent))


def window_prints(docs: DataFrame, maps: Maps, k: int, percent: int) -> DataFrame:
    """Windows of ``docs`` (doc_id, text) that may reach the similarity, as SCHEMA."""
    shared = docs.sparkSession.sparkContext.broadcast(maps)  # 32 MB at most, and the items' sizes

    def whole(group: Words, sizes: list[int], maps: Maps) -> Iterator[tuple]:
        """Windows that are one shingle: those of items with fewer than ``k`` words."""
        bounds = group.bounds()
        for size in sizes:
            at = group.runs(size)
            h = run_hashes(group.hash, at, size)
            hit = _has(maps.by_size, _slots(h, maps.bits, size))
            if hit.any():
                at, h = at[hit], h[hit]
                row = group.row[at]
                prints = simhash(group.hash, at, size).view(np.int64)
                for i, s, p, x in zip(row.tolist(), (at - bounds[row]).tolist(), prints.tolist(), h):
                    yield i, s, size, size, p, [int(x.view(np.int64))], leading(np.array([x]), 1)

    def long(group: Words, sizes: list[int], maps: Maps) -> Iterator[tuple]:
        # no shorter sequence is similar to a size's items than one all of whose shingles are theirs
        least = min((-(-(n - k + 1) * percent // 100) for n in sizes), default=0)
        at = group.runs(k)
        h = run_hashes(group.hash, at, k)
        hit = np.flatnonzero(_has(maps.any_size, _slots(h, maps.bits)))
        row, n_hits = np.unique(group.row[at[hit]], return_counts=True)
        bounds = group.bounds()
        cuts = np.searchsorted(group.row[at[hit]], row)
        for i, c, n in zip(row.tolist(), cuts, n_hits):
            if n < least:
                continue
            a, b = int(bounds[i]), int(bounds[i + 1])
            own = hit[c : c + n]
            first = np.searchsorted(at, a)  # this document's first shingle
            for size in sizes:
                length = min(size, b - a)
                m = length - k + 1
                need = needed(m, size - k + 1, percent)
                if m < need or n < need:
                    continue
                sure = own[_has(maps.by_size, _slots(h[own], maps.bits, size))] - first
                if len(sure) < need:
                    continue
                mark = np.zeros(b - a - k + 2, dtype=np.int32)
                mark[sure + 1] = 1
                np.cumsum(mark, out=mark)
                starts = np.flatnonzero(mark[m:] - mark[:-m] >= need)
                if not len(starts):
                    continue
                prints = simhash(group.hash, starts + a, length).view(np.int64).tolist()
                for s, p in zip(starts.tolist(), prints):
                    got = h[first + s : first + s + m]
                    yield i, s, size, length, p, got.view(np.int64).tolist(), leading(got, need)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = shared.value
        short, rest = [n for n in maps.sizes if n < k], [n for n in maps.sizes if n >= k]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist() if maps.sizes else []
            for group in words(lowered(batch.column("text")), SYMBOLS, size=SMALL_GROUP) if maps.sizes else ():
                rows = []
                for found in (whole(group, short, maps), long(group, rest, maps)):
                    for i, *window in found:
                        rows.append((ids[group.first_row + i], *window))
                        if len(rows) >= 2000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(tidied(make), SCHEMA)


def block_edges(radius: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, 64, radius // 3 + 2).astype(int).tolist()
    return list(zip(edges[:-1], edges[1:]))


def blocks(print_: Column, radius: int) -> list[Column]:
    """The blocks of a fingerprint."""
    return [
        F.shiftrightunsigned(F.shiftleft(print_, 64 - high), 64 - high + low)
        for low, high in block_edges(radius)
    ]


def near_blocks(print_: Column, radius: int) -> list[Column]:
    """For each block of a fingerprint, the array of values within ``FLIPS`` bits."""

    def near(value: Column, width: int) -> Column:
        flips = [sum(1 << b for b in c) for n in range(FLIPS + 1) for c in combinations(range(width), n)]
        return F.transform(
            F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: f.bitwiseXOR(value)
        )

    widths = [high - low for low, high in block_edges(radius)]
    return [near(*pair) for pair in zip(blocks(print_, radius), widths)]


def find_passages(
    docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, radius: int = 23
) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): the best window of each pair.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored.  A window qualifies if it is
    within ``radius`` bits and its similarity is ``percent`` or more; ties go to the first in the text.  Positions count
    words, and ``n_words`` is the window's own: a document with fewer words than the item is compared as a whole.
    Items with fewer than ``k`` words match where their words stand in a row.  Items and rows without an id or without words
    take no part.  Rows that share a doc_id are searched one by one and reported together.
    """
    prints = materialize(item_prints(items, k, percent), "items")
    maps = bitmaps(prints)
    windows = materialize(
        window_prints(docs.where("doc_id is not null"), maps, k, percent), "item-windows"
    )
    mine = windows.select(
        F.col("id").alias("doc_id"),
        "start",
        "size",
        "n_words",
        F.col("print").alias("dp"),
        "first",
        F.posexplode(F.array(*blocks(F.col("print"), radius))).alias("block", "value"),
    ).withColumn("shingle", F.explode("first"))
    theirs = prints.select(
        F.col("id").alias("item_id"),
        "size",
        F.col("print").alias("ip"),
        F.explode("first").alias("shingle"),
        F.array(*near_blocks(F.col("print"), radius)).alias("near"),
    )
    theirs = theirs.select("item_id", "size", "ip", "shingle", F.posexplode("near").alias("block", "values"))
    theirs = theirs.withColumn("value", F.explode("values")).drop("values")
    near = (
        mine.join(theirs, ["size", "shingle", "block", "value"])
        .withColumn("distance", F.bit_count(F.col("dp").bitwiseXOR(F.col("ip"))))
        .where(F.col("distance") <= radius)
        .select("doc_id", "start", "size", "n_words", "dp", "item_id", "distance")
        .distinct()
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, na = np.unique(x.values.to_numpy(zero_copy_only=False), return_counts=True)
                b, nb = np.unique(y.values.to_numpy(zero_copy_only=False), return_counts=True)
                _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                both = int(np.minimum(na[i], nb[j]).sum())
                out.append(both / (int(na.sum()) + int(nb.sum()) - both))
            names = ["doc_id", "item_id", "start", "n_words", "distance"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(out, type=pa.float64())],
                names=[*names, "similarity"],
            )

    own = windows.select(
        F.col("id").alias("doc_id"),
        "start",
        "size",
        "n_words",
        F.col("print").alias("dp"),
        F.col("shingles").alias("x"),
    )
    exact = (
        near.join(own, ["doc_id", "start", "size", "n_words", "dp"])
        .join(prints.select(F.col("id").alias("item_id"), F.col("shingles").alias("y"), "size"), ["item_id", "size"])
        .select("doc_id", "item_id", "start", "n_words", "distance", "x", "y")
        .mapInArrow(
            tidied(measure),
            "doc_id bigint, item_id bigint, start bigint, n_words bigint, distance int, similarity double",
        )
        .where(F.col("similarity") * 100 >= percent)
    )
    best = F.struct("similarity", -F.col("start"), "n_words", "distance")
    return (
        exact.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.col2")).alias("start"),
            "best.n_words",
            "best.distance",
            "best.similarity",
        )
    )
