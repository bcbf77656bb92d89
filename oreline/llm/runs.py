"""Finds periodic runs of words and keeps one period of each: recursive frequency splitting, then a lag scan.

A run is a stretch of consecutive words with smallest period q and a length of at least max(24, 3 q) that no
neighbouring word extends keeping period q.

1. Splitting.  Every word of a run occurs at least three times in it.  So a word that occurs less often within
   its segment is in no run there and splits the segment; the parts are judged anew, until nothing changes.
   Parts shorter than the shortest run are dropped.  All segments of a group of texts are split at once.
2. Lag scan.  For every lag q that three periods leave room for, the surviving segments are compared with themselves q words
   on.  A run of period q agrees with itself over 2 q words at least, so it holds a multiple of q from which more than
   q words agree: only multiples of the lag are looked at, n log n places for a segment of n words, and agreement is told by
   fingerprints of prefixes.  Every run found is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from oreline.llm.words import kept_text, mix, words

#: The least length of a run, in words and in periods.
LEAST, PERIODS = 24, 3
#: Rounds of splitting; segments that still shrink then are scanned as they are, with the same result.
ROUNDS = 256
#: Places of a lag scan looked at at once.
BLOCK = 1 << 19

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

#: Primes below 2**31, and bases: two fingerprints modulo primes.
_PRIMES = tuple(np.uint64(p) for p in (2147483647, 2147483629))
_BASES = tuple(np.uint64(b) for b in (1234567891, 987654323))


def segments(row: np.ndarray, word: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the segments that no rare word splits any more; ``row`` marks the text of each word."""
    cut = np.flatnonzero(row[1:] != row[:-1]) + 1
    start, end = np.concatenate(([0], cut)), np.append(cut, len(row))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        long = end - start >= least
        start, end = start[long], end[long]
        if not len(start):
            break
        size = end - start
        own = np.repeat(np.arange(len(start)), size)
        at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        code, distinct = pd.factorize(mix(word[at] ^ mix(own.astype(np.uint64) + np.uint64(1))))
        rare = np.bincount(code, minlength=len(distinct))[code] < PERIODS
        split = np.zeros(len(start), dtype=bool)
        split[own[rare]] = True
        done.append((start[~split], end[~split]))
        # what lies between rare words, in the segments that have some
        keep = ~rare & split[own]
        edge = np.diff(np.concatenate(([False], keep, [False])).astype(np.int8))
        begins, stops = edge[:-1] == 1, edge[1:] == -1
        apart = np.flatnonzero(keep[1:] & keep[:-1] & (own[1:] != own[:-1])) + 1
        begins[apart] = True
        stops[apart - 1] = True
        start, end = at[begins], at[stops] + 1
    else:
        done.append((start, end))
    if not done:
        return start, end
    start, end = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


class Agreement:
    """How far two places of a sequence agree, by fingerprints of its prefixes."""

    def __init__(self, word: np.ndarray):
        self.n = len(word)
        self.sums, self.powers = [], []
        for prime, base in zip(_PRIMES, _BASES):
            power = np.ones(self.n + 1, dtype=np.uint64)
            have, step = 1, base
            while have <= self.n:  # doubling: the next powers are the known ones times base**have
                more = min(have, self.n + 1 - have)
                power[have : have + more] = power[:more] * step % prime
                step = step * step % prime
                have += more
            value = mix(word ^ base) % prime * power[:-1] % prime
            total = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(value, out=total[1:])
            self.sums.append(total % prime)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from a and from b > a agree; False where the sequence ends before."""
        fits = (b + size <= self.n) & (a >= 0)
        a, b, size = np.where(fits, a, 0), np.where(fits, b, 0), np.where(fits, size, 0)
        for prime, total, power in zip(_PRIMES, self.sums, self.powers):
            one = (total[a + size] + prime - total[a]) % prime * power[b - a] % prime
            fits &= one == (total[b + size] + prime - total[b]) % prime
        return fits

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """The number of words, up to ``most``, that agree from a and b on, or before them."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high + 1) // 2, low)
            shift = 0 if forward else middle
            same = self.same(a - shift, b - shift, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low


def _places(n: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) in blocks: the multiples of every lag that leaves room for a run."""
    lags = np.arange(1, min(n // PERIODS, n - 1) + 1) if n >= least else np.empty(0, dtype=np.int64)
    number = (n - 1 - lags) // lags + 1
    ends = np.cumsum(number)
    first = 0
    while first < len(lags):
        before = ends[first] - number[first]
        last = max(first + 1, int(np.searchsorted(ends, before + BLOCK, side="right")))
        count = number[first:last]
        lag = np.repeat(lags[first:last], count)
        yield (np.arange(len(lag)) - np.repeat(np.cumsum(count) - count, count)) * lag, lag
        first = last


def scan(word: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment, by start and period."""
    n, found = len(word), []
    agreement: Agreement | None = None
    for a, q in _places(n, least):
        near = word[a] == word[a + q]
        a, q = a[near], q[near]
        need = np.maximum((PERIODS - 1) * q, least - q)
        if not len(a):
            continue
        agreement = agreement or Agreement(word)
        ahead = agreement.same(a, a + q, need - q + 1)
        a, q, need = a[ahead], q[ahead], need[ahead]
        # the first multiple of the lag within a run stands for it
        first = ~agreement.same(a - q, a, q)
        a, q = a[first], q[first]
        before = agreement.reach(a, a + q, np.minimum(a, q - 1), forward=False)
        after = agreement.reach(a, a + q, n - a - q, forward=True)
        found.append((a - before, a + after + q, q))
    if not found:
        return []
    start, end, lag = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((lag, end, start))
    runs: dict[tuple[int, int], int] = {}
    known = None
    for s, e, q in zip(start[order].tolist(), end[order].tolist(), lag[order].tolist()):
        if (s, e) == known:
            continue  # a multiple of the smallest period gives the same stretch
        left, right = _checked(word, s, e, q)
        if right - left >= max(least, PERIODS * q):
            runs[left, right] = min(q, runs.get((left, right), q))
            known = (s, e) if (left, right) == (s, e) else known
    return sorted(((s, e - s, q) for (s, e), q in runs.items()), key=lambda r: (r[0], r[2]))


def _checked(word: np.ndarray, s: int, e: int, lag: int) -> tuple[int, int]:
    """The stretch word by word; where fingerprints erred, what really agrees around its first differing word."""
    same = word[s : e - lag] == word[s + lag : e]
    if same.all():
        return s, e
    at = np.flatnonzero(~same)
    edges = np.concatenate(([-1], at, [len(same)]))
    widest = int(np.argmax(np.diff(edges)))
    return s + int(edges[widest]) + 1, s + int(edges[widest + 1]) + lag


@dataclass
class Found:
    """Runs of one text."""

    runs: list[tuple[int, int, int]]

    def dropped(self, n: int) -> np.ndarray:
        """Which of ``n`` words stand after the first period of a run that holds them."""
        change = np.zeros(n + 1, dtype=np.int64)
        for start, length, period in self.runs:
            change[start + period] += 1
            change[start + length] -= 1
        return np.cumsum(change[:-1]) > 0

    def strongest(self) -> dict | None:
        """The run with most periods, compared exactly; of equals the first, then the shorter period."""
        best = None
        for run in self.runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        return best and dict(zip(("start", "length", "period"), best))


def find_runs(row: np.ndarray, word: np.ndarray, n_rows: int, least: int = LEAST) -> list[Found]:
    """The runs of each text, given the row and the hash of each word."""
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    found = [Found([]) for _ in range(n_rows)]
    if len(row):
        for s, e in zip(*(x.tolist() for x in segments(row, word, least))):
            own = int(row[s])
            shift = s - int(bounds[own])
            found[own].runs += [(a + shift, size, lag) for a, size, lag in scan(word[s:e], least)]
    return found


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Of ``docs`` (doc_id, text): doc_id, n_words, runs, strongest, n_dropped, collapsed_text.

    Words are what lies between ``[\\x20\\x09-\\x0D]``, numbered from 0.  ``runs`` are (start, length, period) by start
    and period; ``strongest`` is the one with most periods (null without runs).  A word that a run holds after its first period is dropped; the
    others, joined by one space, are ``collapsed_text``.  Each row is judged by itself, whatever its doc_id, so repeated rows
    give repeated results; null and empty texts have no words and an empty text.  Other columns are left out.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in words(batch.column("text")):
                bounds = group.bounds()
                found = find_runs(group.row, group.hash, group.n_rows, least)
                drop = np.concatenate([f.dropped(n) for f, n in zip(found, np.diff(bounds).tolist())])
                gone = np.bincount(group.row[drop], minlength=group.n_rows)
                listed = [[dict(zip(("start", "length", "period"), r)) for r in f.runs] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(group.first_row, group.n_rows),
                        pa.array(np.diff(bounds)),
                        pa.array(listed, type=pa.list_(RUN)),
                        pa.array([f.strongest() for f in found], type=RUN),
                        pa.array(gone),
                        kept_text(group, ~drop),
                    ],
                    names=["doc_id", "n_words", "runs", "strongest", "n_dropped", "collapsed_text"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select("doc_id", "text").mapInArrow(
        make,
        f"doc_id {kind}, n_words bigint, runs array<{run}>, strongest {run}, n_dropped bigint, collapsed_text string",
    )
