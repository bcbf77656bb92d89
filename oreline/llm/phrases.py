"""Phrase collocations: direct-address tiling of ranked word ids, counted level by level.

1. Chunks.  Texts of one language are cut into chunks of some megabytes; a chunk is a sequence of codes, with breaks between pieces, and a
   dictionary of its own.  Words are counted per chunk first and summed after, so no word's rows meet unsummed.
2. Ranks.  Words that occur often enough get ids by falling frequency, per language.  Each chunk gets the ids of its own
   words only (a shuffle by chunk), so nothing depends on the vocabulary fitting into one process.
3. Tiles.  Pairs of neighbouring ids are counted per chunk: ids fall into tiles of ``TILE`` x ``TILE`` cells.  Frequent words have small ids, so
   few tiles hold most pairs; those are counted by a dense ``bincount`` over their cells.  The pairs of all other tiles are
   sorted and counted as (row, column, count).
   Counts travel as blocks, one per chunk and shard of a hash of the pair, and are merged per shard; there are as
   many shards as bound a shard's size, and a pair has at most one entry per chunk, so none can grow hot.
4. Recursion.  Pairs that are frequent over all chunks are ranked in turn and take the place of the words: two neighbouring, overlapping
   pairs are a phrase of three words, two such phrases one of four.  A phrase can only be frequent if both parts are.
5. Scores.  A phrase's row carries the counts of all its beginnings and ends, so each cut is judged exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.words import mix, tidied, words
from oreline.operators.joins import lookup_join
from oreline.operators.keys import dense_keys
from oreline.session import discard, materialize

#: Fixed values: ``[.,;:!?\x0A-\x0D]`` end a piece, ``[\x20\x09]`` a word.
ENDS = (*range(0x0A, 0x0E), *map(ord, ".,;:!?"))
BLANKS = (0x20, 0x09)

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Cells along one side of a tile, and pairs per cell from which a tile is counted densely.
TILE, DENSE = 256, 1 / 8
#: Words for each shard of the pairs' hashes.
SHARD_WORDS = 1_000_000


def chunks(texts: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, lang, ids, code, word, n): for each chunk one row with its ``ids``, and one per distinct word.

    ``ids`` are 32-bit codes of the chunk's words; -1 parts pieces.
    """
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] = fold[97:123]
    ending = np.zeros(256, dtype=bool)
    ending[list(ENDS)] = True
    names = ["chunk", "lang", "ids", "code", "word", "n"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.string(), pa.int64()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            which, langs = pd.factorize(batch.column("lang").to_numpy(zero_copy_only=False))
            for i, lang in enumerate(langs):
                some = batch.column("text").filter(pa.array(which == i))
                for group in words(some, (*BLANKS, *ENDS), lower=True, size=size):
                    if not len(group.hash):
                        continue
                    code, distinct = pd.factorize(group.hash)
                    first = np.empty(len(distinct), dtype=np.int64)
                    first[code[::-1]] = np.arange(len(code))[::-1]
                    piece = np.cumsum(ending[group.data], dtype=np.int32)[group.start]
                    new = (group.row[1:] != group.row[:-1]) | (piece[1:] != piece[:-1])
                    at = np.arange(len(code)) + np.concatenate(([0], np.cumsum(new)))
                    ids = np.full(at[-1] + 1, -1, dtype=np.int32)
                    ids[at] = code
                    long = group.end[first] - group.start[first]
                    edge = np.concatenate(([0], np.cumsum(long)))
                    source = np.arange(edge[-1]) + np.repeat(group.start[first] - edge[:-1], long)
                    listed = pa.StringArray.from_buffers(
                        len(first),
                        pa.py_buffer(edge.astype(np.int32)),
                        pa.py_buffer(fold[group.data[source]]),
                    )
                    one = [[chunk], [lang], [ids.tobytes()], [None], [None], [None]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=k) for x, k in zip(one, kinds)], names=names)
                    many = [
                        pa.array(np.full(len(first), chunk)),
                        pa.array([lang]).take(pa.array(np.zeros(len(first), dtype=np.int32))),
                        pa.nulls(len(first), pa.binary()),
                        pa.array(np.arange(len(first), dtype=np.int32)),
                        listed,
                        pa.array(np.bincount(code)),
                    ]
                    yield pa.RecordBatch.from_arrays(many, names=names)
                    chunk += 1

    return texts.mapInArrow(
        tidied(make), "chunk bigint, lang string, ids binary, code int, word string, n bigint"
    )


def _apart(df: DataFrame) -> DataFrame:
    """The same rows under column identities of their own, to be joined with frames from the same files."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _look(large: DataFrame, lookup: DataFrame, keys: list[str], spread: str, how: str = "inner") -> DataFrame:
    return lookup_join(large, _apart(lookup), keys, spread, how)


def ranked(found: DataFrame, by: list[str]) -> DataFrame:
    """``found`` (lang, a, and ``by``) with ``id``: 0, 1, ... per language by falling ``a``, then ``by``."""
    ordered = found.withColumn("_down", -F.col("a"))
    numbered = dense_keys(ordered, "_id", ["lang", "_down", *by]).drop("_down")
    first = numbered.groupBy("lang").agg(F.min("_id").alias("_first"))
    return materialize(
        _look(numbered, first, ["lang"], "_id")
        .withColumn("id", F.col("_id") - F.col("_first"))
        .drop("_id", "_first"),
        "ranked",
    )


def tile_counts(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, count) of the distinct pairs of ids below ``n``, small ids being the frequent ones."""
    side = n // TILE + 1
    tile = left // TILE * side + right // TILE
    numbers, which = np.unique(tile, return_inverse=True)
    filled = np.bincount(which, minlength=len(numbers))
    dense = filled >= TILE * TILE * DENSE
    parts = []
    if dense.any():
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(filled)
        cell = (left % TILE * TILE + right % TILE)[order]
        for t in np.flatnonzero(dense):
            count = np.bincount(cell[ends[t] - filled[t] : ends[t]], minlength=TILE * TILE)
            at = np.flatnonzero(count)
            row, column = divmod(int(numbers[t]), side)
            parts.append((row * TILE + at // TILE, column * TILE + at % TILE, count[at]))
    sparse = ~dense[which]
    if sparse.any():
        key, count = np.unique(left[sparse] * np.int64(n) + right[sparse], return_counts=True)
        parts.append((key // n, key % n, count))
    if not parts:
        return (np.empty(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts))


_KINDS = tuple(np.dtype(t) for t in ("u1", "<u2", "<u4", "<i8"))


def _block(*columns: np.ndarray) -> bytes:
    """Columns of counts or ids as bytes, each in the smallest type that holds it; first all low bytes, and so on,
    as the high ones are alike and shrink when they are shuffled."""
    parts = [np.int64(len(columns[0])).tobytes()]
    for column in columns:
        most = int(column.max(initial=0))
        kind = next(i for i, k in enumerate(_KINDS) if most <= np.iinfo(k).max)
        whole = np.ascontiguousarray(column, dtype=_KINDS[kind]).view(np.uint8)
        parts += [bytes([kind]), whole.reshape(len(column), _KINDS[kind].itemsize).T.tobytes()]
    return b"".join(parts)


def _unblock(block: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(block, dtype=np.int64, count=1)[0])
    at, columns = 8, []
    while at < len(block):
        kind = _KINDS[block[at]]
        planes = np.frombuffer(block, dtype=np.uint8, count=n * kind.itemsize, offset=at + 1)
        whole = np.ascontiguousarray(planes.reshape(kind.itemsize, n).T)
        columns.append(whole.reshape(-1).view(kind).astype(np.int64))
        at += 1 + n * kind.itemsize
    return columns


def _stream(ids: np.ndarray) -> bytes:
    """Ids with breaks (-1) as bytes."""
    return _block(ids + 1)


def _ids(stream: bytes) -> np.ndarray:
    return _unblock(stream)[0] - 1


def _order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The order by left, then right; by one key where both fit into it."""
    side = int(right.max(initial=0)) + 1
    if int(left.max(initial=0)) < 2**62 // side:
        return np.argsort(left * side + right, kind="stable")
    return np.lexsort((right, left))


def _neighbours(ids: np.ndarray) -> np.ndarray:
    """Positions whose entry and the next are both ids."""
    return np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))


def _pairs_of(ids: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """(own, left, right, n, shard) of a chunk, by shard and left; left and right are places in ``own``, the chunk's ids."""
    at = _neighbours(ids)
    # A chunk's own ids, closed up; their order by frequency stays.
    own, local = np.unique(ids, return_inverse=True)
    left, right, n = tile_counts(local[at], local[at + 1], len(own))
    mixed = mix(mix(own[left].view(np.uint64)) ^ own[right].view(np.uint64))
    shard = (mixed % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((right, left, shard))
    return own, left[order], right[order], n[order], shard[order]


def pair_counts(stream: DataFrame, shards: int) -> DataFrame:
    """(chunk, lang, shard, block): blocks of (step of left, right, n), how often neighbouring ids meet in each chunk."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of = batch.column("ids")
            for i, (chunk, lang) in enumerate(zip(batch.column("chunk").to_pylist(), batch.column("lang").to_pylist())):
                own, left, right, n, shard = _pairs_of(_ids(ids_of[i].as_py()), shards)
                left, right = own[left], own[right]
                numbers, begin = np.unique(shard, return_index=True)
                ends = np.append(begin[1:], len(shard))
                blocks = [_block(np.diff(left[a:b], prepend=0), right[a:b], n[a:b]) for a, b in zip(begin, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(numbers), type=pa.int64()),
                        pa.array([lang] * len(numbers), type=pa.string()),
                        pa.array(numbers),
                        pa.array(blocks, type=pa.binary()),
                    ],
                    names=["chunk", "lang", "shard", "block"],
                )

    return stream.mapInArrow(tidied(make), "chunk bigint, lang string, shard bigint, block binary")


def frequent_pairs(counted: DataFrame, least: int, shards: int) -> DataFrame:
    """The pairs that all chunks together hold at least ``least`` times, and which of its pairs each chunk finds among them.

    Rows with (lang, left, right, a, id) are the pairs.  Ids rank them by falling count: those of one shard are ``shards``
    apart, so the shards' most frequent pairs have the smallest ids.  Rows with (chunk, shard, block) answer a chunk's block: for
    each of its pairs, in order, 1 more than the rank within the shard, or 0.
    """
    names = ["lang", "left", "right", "a", "id", "chunk", "shard", "block"]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.binary()]

    def merge(key: tuple, blocks: pa.Table) -> pa.Table:
        shard = key[1].as_py()
        held = [_unblock(b) for b in blocks.column("block").to_pylist()]
        left = np.concatenate([np.cumsum(h[0]) for h in held])
        right, n = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        order = _order(left, right)
        left, right = left[order], right[order]
        new = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first)
        often = np.flatnonzero(total >= least)
        rank = np.full(len(first), -1, dtype=np.int64)
        rank[often[np.lexsort((often, -total[often]))]] = np.arange(len(often))
        # the rank of every entry, back in the order of the blocks
        ranks = np.empty(len(order), dtype=np.int64)
        ranks[order] = rank[np.cumsum(new) - 1] + 1
        cuts = np.cumsum([len(h[0]) for h in held])[:-1]
        answers = [_block(a) if a.any() else None for a in np.split(ranks, cuts)]
        some = [i for i, a in enumerate(answers) if a is not None]
        chunk = blocks.column("chunk").to_pylist()
        p, c = len(often), len(some)
        columns = [
            [key[0].as_py()] * p + [None] * c,
            *[[*x[first][often].tolist(), *[None] * c] for x in (left, right)],
            [*total[often].tolist(), *[None] * c],
            [*(rank[often] * shards + shard).tolist(), *[None] * c],
            [None] * p + [chunk[i] for i in some],
            [None] * p + [shard] * c,
            [None] * p + [answers[i] for i in some],
        ]
        return pa.table([pa.array(x, type=k) for x, k in zip(columns, kinds)], names=names)

    return counted.groupBy("lang", "shard").applyInArrow(
        merge,
        "lang string, left bigint, right bigint, a bigint, id bigint, chunk bigint, shard bigint, block binary",
    )


def _squeezed(ids: np.ndarray) -> np.ndarray:
    """``ids`` without what has no neighbour; one -1 parts what is left."""
    some = ids >= 0
    beside = np.zeros(len(ids), dtype=bool)
    beside[1:] |= some[:-1]
    beside[:-1] |= some[1:]
    kept = some & beside
    keep = kept.copy()
    keep[1:] |= kept[:-1]
    return np.where(kept, ids, -1)[keep]


def _recoded(stream: DataFrame, dictionary: DataFrame, make) -> DataFrame:
    """The stream with new ids that ``make`` gives from a chunk's ids and its part of ``dictionary``."""

    def recode(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for chunk, lang, raw in zip(*(left.column(c).to_pylist() for c in ("chunk", "lang", "ids"))):
            ids = _squeezed(make(raw, right)) if len(right) else np.empty(0, dtype=np.int64)
            if len(ids):
                rows.append((chunk, lang, _stream(ids)))
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table(
            [pa.array(c, type=k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary()))],
            names=["chunk", "lang", "ids"],
        )

    return materialize(
        stream.groupBy("chunk")
        .cogroup(_apart(dictionary).groupBy("chunk"))
        .applyInArrow(recode, "chunk bigint, lang string, ids binary"),
        "phrase-stream",
    )


def with_ids(stream: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Streams of a chunk's own codes as streams of ids; ``dictionary``: (chunk, code, id)."""

    def make(raw: bytes, known: pa.Table) -> np.ndarray:
        code = np.frombuffer(raw, dtype=np.int32)
        table = np.full(int(code.max()) + 2, -1, dtype=np.int64)  # the last entry serves -1
        table[known.column("code").to_numpy()] = known.column("id").to_numpy()
        return table[code]

    return _recoded(stream, dictionary, make)


def with_pairs(stream: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """Streams whose ids are those of the pair that starts at each place; ``answers``: (chunk, shard, block)."""

    def make(raw: bytes, known: pa.Table) -> np.ndarray:
        ids = _ids(raw)
        own, left, right, _, shard = _pairs_of(ids, shards)
        rank = np.zeros(len(shard), dtype=np.int64)
        for number, block in zip(known.column("shard").to_pylist(), known.column("block").to_pylist()):
            a, b = np.searchsorted(shard, (number, number + 1))
            rank[a:b] = _unblock(block)[0]
        new_ids = np.where(rank > 0, (rank - 1) * shards + shard, -1)
        key = left * np.int64(len(own)) + right
        order = np.argsort(key)
        key, new_ids = key[order], new_ids[order]
        at = _neighbours(ids)
        local = np.searchsorted(own, ids)
        new = np.full(len(ids), -1, dtype=np.int64)
        new[at] = new_ids[np.searchsorted(key, local[at] * np.int64(len(own)) + local[at + 1])]
        return new

    return _recoded(stream, answers, make)


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _judged(level: DataFrame, m: int) -> DataFrame:
    """(lang, id, phrase, a, l, r, score) by the cut with the lowest score, the first of equals."""
    a = F.get("begins", F.lit(m - 1))
    cuts = []
    for k in range(1, m):
        l, r = F.get("begins", F.lit(k - 1)), F.get("ends", F.lit(m - k - 1))
        score = F.call_function("div", _exact(a) * F.lit(2_000_000).cast("decimal(10,0)"), _exact(l) + _exact(r))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    cut = F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]
    return level.select("lang", "id", "phrase", a.alias("a"), cut.alias("cut")).select(
        "lang", "id", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def _uncovered(judged: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Phrases that no phrase of one more word (lang, left, right, a) holds in ``percent`` of their places.

    One of two more words holds a phrase only through one of one more word, which is at least as frequent.
    """
    holds = (
        longer.select("lang", F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("_most"))
        .groupBy("lang", "id")
        .agg(F.max("_most").alias("_most"))
    )
    covered = _exact(F.col("_most")) * 100 >= _exact(F.col("a")) * percent
    return (
        _look(judged, holds, ["lang", "id"], "id", "left")
        .where(~F.coalesce(covered, F.lit(False)))
        .drop("_most")
    )


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, covered: int = 80, top: int = 2000, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The best phrases of 2 to ``longest`` words per language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang (null: ``und``) and text; other columns do not matter.  Texts are lower-cased (A-Z), cut into pieces at
    ``[.,;:!?\\x0A-\\x0D]`` and those into words at blanks and tabs.  ``a`` is how often the phrase occurs within pieces, overlaps included, ``l`` and
    ``r`` how often the two parts of its worst cut do, ``n`` all words of the language; score is floor(2000000 a / (l + r)).
    Phrases found less than ``least`` times are no candidates; those that lie in a longer candidate with ``covered`` per cent of
    their count are left out.  The first ``top`` by score, a, and phrase are returned.

    Every row counts as a text, repeated ones, too.  Null and empty texts hold no words; a language without
    candidates, and an empty table, give no rows.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    cut = materialize(chunks(texts, chunk_bytes), "phrase-chunks")
    counted = cut.where("word is not null").select("chunk", "lang", "code", "word", "n")
    totals = materialize(counted.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    often = counted.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    frequent = ranked(materialize(often, "phrase-frequent"), ["word"])
    local = _look(counted.drop("n"), frequent.drop("a"), ["lang", "word"], "chunk")
    stream = with_ids(cut.where("ids is not null").select("chunk", "lang", "ids"), local.select("chunk", "code", "id"))
    level = frequent.select(
        "lang",
        "id",
        F.col("word").alias("phrase"),
        F.col("word").alias("last"),
        F.array("a").alias("begins"),
        F.array("a").alias("ends"),
    )
    discard(cut)
    words_in_all = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    shards = 1 + words_in_all // SHARD_WORDS
    judged: list[DataFrame] = []
    for m in range(2, longest + 1):
        met = materialize(frequent_pairs(pair_counts(stream, shards), least, shards), "phrase-pairs")
        pairs = materialize(met.where("block is null").select("lang", "left", "right", "a", "id"), "phrase-frequent")
        if judged:
            judged[-1] = _uncovered(judged[-1], pairs, covered)
        begins = level.select("lang", F.col("id").alias("left"), F.col("phrase").alias("_phrase"), F.col("begins").alias("_begins"))
        ends = level.select("lang", F.col("id").alias("right"), "last", F.col("ends").alias("_ends"))
        both = _look(_look(pairs, begins, ["lang", "left"], "id"), ends, ["lang", "right"], "id")
        level = materialize(
            both.select(
                "lang",
                "id",
                F.concat_ws(" ", "_phrase", "last").alias("phrase"),
                "last",
                F.concat("_begins", F.array("a")).alias("begins"),
                F.concat("_ends", F.array("a")).alias("ends"),
            ),
            "phrase-level",
        )
        judged.append(_judged(level, m))
        if m < longest:
            before, stream = stream, with_pairs(stream, met.where("block is not null").select("chunk", "shard", "block"), shards)
            discard(before)
        discard(met)
    phrases = judged[0].drop("id")
    for more in judged[1:]:
        phrases = phrases.unionByName(more.drop("id"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        _look(phrases.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top), totals, ["lang"], "rank")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang
), grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM lists), (VALUES (1), (2), (3), (4)) sizes(m)
  WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f), k) AS place
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
), parts AS (
  SELECT lang, a, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, m)) AS i FROM candidates), (VALUES (2), (3)) sizes(s)
  WHERE s < m AND i + s - 1 <= m
), placed AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.phrase) AS rank
  FROM cuts c
  WHERE place = 1 AND NOT EXISTS (
    SELECT 1 FROM parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100::HUGEINT * p.a >= 80::HUGEINT * c.a)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""
