"""Words of many texts at once: positions and 64-bit hashes, by numpy.

Each text is a row of an Arrow array.  Rows are taken in groups of a few
megabytes; a longer text makes a group of its own and is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 2 << 20
#: The same where many numbers are made of each word.
SMALL_GROUP = 1 << 19
#: ``[\x20\x09-\x0D]``
BLANKS = tuple(range(0x09, 0x0E)) + (0x20,)
#: ASCII other than letters and digits
SYMBOLS = tuple(b for b in range(128) if not chr(b).isalnum())

#: Blocks of 8 bytes of a word that are read whole; what is longer is read entry by entry.
WHOLE = 6
#: Entries of overlapping spans handled at once.
BLOCK = 1 << 20

_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


_PLACES = mix(np.arange(1, WHOLE + 1, dtype=np.uint64) << np.uint64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span; equal spans, equal hashes.

    It is a sum over the entries, each spread together with its place.  (A polynomial modulo 2**64 would
    be cheaper, but whole families of spans collide under it, whatever the base.)
    """
    size = ends - starts
    bounds = np.concatenate(([0], np.cumsum(size)))
    total = np.zeros(len(starts), dtype=np.uint64)
    for low in range(0, int(bounds[-1]), BLOCK):
        high = min(low + BLOCK, int(bounds[-1]))
        first = np.searchsorted(bounds, low, side="right") - 1
        last = np.searchsorted(bounds, high, side="left")
        count = np.minimum(bounds[first + 1 : last + 1], high) - np.maximum(bounds[first:last], low)
        place = np.arange(low, high) - np.repeat(bounds[first:last], count)
        entry = values[np.repeat(starts[first:last], count) + place].astype(np.uint64)
        spread = mix(entry ^ mix(place.astype(np.uint64)))
        upto = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(spread)))
        at = np.cumsum(count)
        total[first:last] += upto[at] - upto[at - count]
    return mix(total + size.astype(np.uint64) * _LENGTH)


def text_hashes(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes or code points; a sum over blocks of 8 bytes and their places."""
    per = 8 // code.itemsize
    blocks = np.lib.stride_tricks.sliding_window_view(np.append(code, np.zeros(per, code.dtype)), per)
    size = ends - starts
    total = size.astype(np.uint64) * _LENGTH
    which = np.flatnonzero(size > 0)
    for i in range(WHOLE):
        at, left = starts[which] + i * per, size[which] - i * per
        block = np.ascontiguousarray(blocks[at]).view(np.uint64).ravel()
        unused = (np.maximum(per - left, 0) * (64 // per)).astype(np.uint64)
        total[which] += mix((block << unused) ^ _PLACES[i])
        which = which[left > per]
        if not len(which):
            return mix(total)
    total[which] += span_hashes(code, starts[which] + WHOLE * per, ends[which])
    return mix(total)


@dataclass
class Words:
    """Words of some rows, in order."""

    first_row: int
    n_rows: int
    row: np.ndarray  # row of each word, from 0 at first_row
    start: np.ndarray  # byte positions in data
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray  # the group's bytes

    def bounds(self) -> np.ndarray:
        """Where each row's words begin; one more entry closes the last."""
        return np.searchsorted(self.row, np.arange(self.n_rows + 1))

    def runs(self, k: int) -> np.ndarray:
        """Positions at which ``k`` words of one row begin."""
        n = len(self.row) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        return np.flatnonzero(self.row[:n] == self.row[k - 1 :])


def kept_text(group: Words, keep: np.ndarray) -> pa.Array:
    """The words of each row that ``keep`` marks, joined by one space."""
    start, long = group.start[keep], (group.end - group.start)[keep] + 1
    edge = np.cumsum(long)
    source = np.arange(edge[-1] if len(edge) else 0) + np.repeat(start - (edge - long), long)
    data = np.append(group.data, np.uint8(0x20))[source]
    data[edge - 1] = 0x20
    row = group.row[keep]
    last = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else edge
    data = np.delete(data, edge[last] - 1)
    upto = np.concatenate(([0], edge))[np.searchsorted(row, np.arange(group.n_rows + 1))]
    upto -= np.searchsorted(row[last], np.arange(group.n_rows + 1))
    return pa.LargeStringArray.from_buffers(
        group.n_rows, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data)
    ).cast(pa.string())


def run_hashes(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` entries from each position, depending on their order."""
    h = hashes[at]
    for j in range(1, k):
        h = mix(h * np.uint64(0xA24BAED4963EE407) + hashes[at + j])
    return mix(h + np.uint64(k))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, and where each row begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return raw, offsets


def tidied(make: Callable) -> Callable:
    """``make`` for a task, giving freed memory back to the system at its end, as workers wait for tasks to come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from make(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def row_groups(offsets: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def words(
    texts: pa.Array,
    separators: tuple[int, ...] = BLANKS,
    lower: bool = False,
    size: int = GROUP_BYTES,
) -> Iterator[Words]:
    """The words between ``separators``, in groups of about ``size`` bytes; ``lower`` folds A-Z for the hashes."""
    apart = np.zeros(256, dtype=bool)
    apart[list(separators)] = True
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] = fold[97:123]
    raw, offsets = utf8(texts)
    for first, last in row_groups(offsets, size):
        low = offsets[first]
        data = raw[low : offsets[last]]
        edges = offsets[first : last + 1] - low
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = ~apart[data]
        change = np.diff(inside)
        begins, ends = change[:-1] == 1, change[1:] == -1
        # a row's edge parts words, too
        inner = edges[(edges > 0) & (edges < len(data))]
        cut = inner[(inside[inner + 1] == 1) & (inside[inner] == 1)]
        begins[cut] = True
        ends[cut - 1] = True
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        row = np.searchsorted(edges, start, side="right") - 1
        folded = fold[data] if lower else data
        yield Words(
            first, last - first, row, start, end, text_hashes(folded, start, end), data
        )
