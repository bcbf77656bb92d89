"""Language identification as inference of a mixture.

Languages are distributions over hashed letter trigrams, counted on labelled documents.
A document is a mixture of languages: expectation-maximisation estimates the proportions for a set of
languages, and the set grows from the best single language while the gain in log-likelihood exceeds a penalty that grows with
the log of the document's length.  The likelihood is concave in a new language's share, so its slope at zero bounds the
gain; languages whose bound is below the penalty need no EM, which settles most documents at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.llm.words import row_groups, tidied, utf8

BUCKETS = 1 << 16
#: Bytes of a text above which its trigrams are counted in slices of as many.
SLICE = 1 << 19
#: Trigrams worked out at once: a few arrays of eight bytes each.
BLOCK = 1 << 18
#: Languages that a model may have.
LANGUAGES = 1000
#: Languages whose counts a task holds at once.
HELD = 64
UNKNOWN = "und"

_letter = re.compile(r"[^\W\d_]")

_FOLD = np.zeros(256, dtype=np.uint8)
for _b in range(128):
    _FOLD[_b] = _b | 0x20 if chr(_b).isalpha() else 0
_FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each trigram of bytes that has a letter; A-Z folded, other ASCII blank.

    A row has a blank at both ends, so a single letter makes trigrams as well.
    """
    n, rows = len(data), len(edges) - 1
    # two blanks after each row, and two before the first
    blank = np.repeat(edges[1:], 2)
    folded = np.concatenate((np.zeros(2, dtype=np.uint8), np.insert(_FOLD[data], blank, 0)))
    ends = edges[1:] + 2 * np.arange(1, rows + 1)  # the last trigram that starts in a row
    row, bucket = [np.empty(0, dtype=np.int32)], [np.empty(0, dtype=np.uint16)]
    for low in range(0, n + 2 * rows, BLOCK):
        code = codes(folded[low : low + BLOCK + 2])
        at = np.flatnonzero(code)
        row.append(np.minimum(np.searchsorted(ends, at + low, side="left"), rows - 1).astype(np.int32))
        bucket.append(buckets(code[at]))
    return np.concatenate(row), np.concatenate(bucket)


def codes(folded: np.ndarray) -> np.ndarray:
    """Three bytes from each place as one number; 0 where none has a letter."""
    part = folded.astype(np.uint32)
    return part[:-2] << 16 | part[1:-1] << 8 | part[2:]


def buckets(code: np.ndarray) -> np.ndarray:
    return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)


def long_counts(data: np.ndarray) -> np.ndarray:
    """How often each bucket occurs among the trigrams of one long row; the same trigrams, in slices."""
    folded = np.zeros(len(data) + 4, dtype=np.uint8)
    folded[2:-2] = _FOLD[data]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for low in range(0, len(data) + 2, SLICE):
        code = codes(folded[low : low + SLICE + 2])
        counts += np.bincount(buckets(code[code > 0]), minlength=BUCKETS)
    return counts


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                bucket = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(bucket), type=pa.string()),
                        pa.array(bucket),
                        pa.array(n[bucket]),
                    ],
                    names=["lang", "bucket", "n"],
                )
            held.clear()

        for batch in batches:
            raw, offsets = utf8(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for first, last in row_groups(offsets):
                low = offsets[first]
                own = langs[first:last]
                long = last - first == 1 and offsets[last] - low > SLICE
                if long:
                    all_counts = long_counts(raw[low : offsets[last]])
                else:
                    row, bucket = trigrams(raw[low : offsets[last]], offsets[first : last + 1] - low)
                for lang in set(own):
                    if lang not in held and len(held) >= HELD:
                        yield from flush()
                    held.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    held[lang] += all_counts if long else np.bincount(bucket[(own == lang)[row]], minlength=BUCKETS)
        yield from flush()

    return (
        docs.select("lang", "text")
        .mapInArrow(tidied(count), "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class Model:
    """log p(bucket | language) for each bucket and language."""

    languages: list[str]
    log_p: np.ndarray

    def mixture(
        self, log_p: np.ndarray, times: np.ndarray, start: list[int], penalty: float, rounds: int = 30
    ) -> tuple[list[int], np.ndarray]:
        """The penalised-likelihood set grown from ``start``, and its proportions.

        ``log_p``: a row per trigram of the document, found as often as ``times`` says; a column per language.
        """
        p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
        chosen, share = start, np.ones(1)
        n, times = times.sum(), times[:, None]
        cost = penalty * np.log(n + 1.0)
        while len(chosen) < len(self.languages):
            now = p[:, chosen] @ share
            level = (np.log(now) @ times)[0]
            slope = ((p / now[:, None] - 1.0) * times).sum(axis=0)
            best = None
            for lang in np.flatnonzero(slope > cost):
                if lang in chosen:
                    continue
                q = p[:, [*chosen, lang]]
                w = np.append(share * 0.8, 0.2)
                for _ in range(rounds):
                    r = q * w
                    w = (r / r.sum(axis=1, keepdims=True) * times).sum(axis=0) / n
                gain = (np.log(q @ w) @ times)[0] - level
                if gain > cost and (best is None or gain > best[0]):
                    best = (gain, int(lang), w)
            if best is None:
                break
            chosen, share = [*chosen, best[1]], best[2]
        return chosen, share


def fit(labelled: DataFrame, smoothing: float = 0.5, background: float = 0.1) -> Model:
    """Counts trigrams of every labelled row (lang, text) and smooths them.

    ``background`` is the weight of the average over languages, mixed into each so that no
    single trigram decides.  What comes to the driver is one row of up to 2**16 counts per language; a table
    with more than ``LANGUAGES`` of them is refused.
    """
    languages = labelled.where("lang is not null").select("lang").distinct().limit(LANGUAGES + 1).count()
    if languages > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    rows = (
        count_trigrams(labelled.where("lang is not null and text is not null"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
        .toArrow()
    )
    order = sorted(range(rows.num_rows), key=lambda i: rows["lang"][i].as_py())
    p = np.zeros((len(order), BUCKETS))
    for to, i in enumerate(order):
        counts = rows["counts"][i].values
        p[to, counts.field("bucket").to_numpy()] = counts.field("n").to_numpy()
    p += smoothing
    p /= p.sum(axis=1, keepdims=True)
    if len(order):
        p = (1 - background) * p + background * p.mean(axis=0)
    return Model([rows["lang"][i].as_py() for i in order], np.log(p).T.astype(np.float32))


def predict(docs: DataFrame, model: Model, penalty: float = 4.0, keys: tuple = ("doc_id",)) -> DataFrame:
    """``keys`` with lang_pred, score, languages and shares (largest first).

    A text that is null or has no letter is ``und`` with score 0 and no languages, and so is every text under a
    model without languages.  ``score`` is the share of lang_pred; where one language is enough, its
    posterior against the others, with each letter counted once instead of in three trigrams.
    Rows may repeat; no input but the text is used.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: 2**16 numbers per language

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            out = [(UNKNOWN, 0.0, [], [])] * batch.num_rows
            texts = batch.column("_text")
            has = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(
                zero_copy_only=False
            )
            raw, offsets = utf8(texts)
            for first, last in row_groups(offsets, 1 << 19) if m.languages else ():
                low = offsets[first]
                if last - first == 1 and offsets[last] - low > SLICE:
                    # each trigram once, with its count: memory does not grow with the text
                    counts = long_counts(raw[low : offsets[last]])
                    bucket = np.flatnonzero(counts)
                    row, times = np.zeros(len(bucket), dtype=np.int64), counts[bucket].astype(np.float64)
                else:
                    row, bucket = trigrams(raw[low : offsets[last]], offsets[first : last + 1] - low)
                    times = np.ones(len(row))
                if not len(row):
                    continue
                log_p = m.log_p[bucket]
                begin = np.searchsorted(row, np.arange(last - first + 1))
                total = np.zeros((len(begin), len(m.languages)))
                np.cumsum(log_p * times[:, None], axis=0, out=(upto := np.empty(log_p.shape)))
                total[begin > 0] = upto[begin[begin > 0] - 1]
                level = np.diff(total, axis=0)
                best = level.argmax(axis=1)
                ratio = np.exp(log_p - log_p[np.arange(len(row)), best[row]][:, None])
                np.cumsum(ratio * times[:, None], axis=0, out=upto)
                total[:] = 0
                total[begin > 0] = upto[begin[begin > 0] - 1]
                n = np.bincount(row, times, minlength=last - first)
                slope = np.diff(total, axis=0) - n[:, None]
                mixed = (slope > (penalty * np.log(n + 1.0))[:, None]).any(axis=1)
                odds = np.exp((level - level.max(axis=1, keepdims=True)) / 3.0)
                alone = 1.0 / odds.sum(axis=1)
                for i in range(last - first):
                    if not n[i] or not has[first + i]:
                        continue
                    if not mixed[i]:
                        one = m.languages[best[i]]
                        out[first + i] = (one, float(alone[i]), [one], [1.0])
                        continue
                    chosen, share = m.mixture(
                        log_p[begin[i] : begin[i + 1]].astype(np.float64), times[begin[i] : begin[i + 1]], [int(best[i])], penalty
                    )
                    order = np.argsort(-share, kind="stable")
                    names = [m.languages[chosen[j]] for j in order]
                    shares = [float(min(1.0, share[j])) for j in order]
                    score = shares[0] if len(names) > 1 else float(alone[i])
                    out[first + i] = (names[0], score, names, shares)
            lang, score, names, shares = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keys]
                + [
                    pa.array(lang, type=pa.string()),
                    pa.array(score, type=pa.float64()),
                    pa.array(names, type=pa.list_(pa.string())),
                    pa.array(shares, type=pa.list_(pa.float64())),
                ],
                names=[*keys, "lang_pred", "score", "languages", "shares"],
            )

    schema = T.StructType(
        [T.StructField(k, docs.schema[k].dataType) for k in keys]
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("languages", T.ArrayType(T.StringType())),
            T.StructField("shares", T.ArrayType(T.DoubleType())),
        ]
    )
    return docs.select(*keys, F.col("text").alias("_text")).mapInArrow(tidied(judge), schema)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in which a language is found, with their own columns, whatever their names."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = predict(rows, model, keys=("row",)).where(F.col("lang_pred") != UNKNOWN)
    return found.select("row.*")


def fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
