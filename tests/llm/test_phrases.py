"""Collocations against counting every phrase."""

from __future__ import annotations

import random

import numpy as np
import pytest

from oreline.llm import phrases, queries
from oreline.llm.ship import ship_package
from tests.conftest import DATA
from tests.llm import brute


def corpus():
    rng = random.Random(11)
    vocabulary = ["New", "york", "City", "é", "中文", "😀", "a", "of", "the", "x-y", "\\", "'"] + [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(300):
        words = rng.choices(vocabulary, weights=[9 if i < 12 else 1 for i in range(len(vocabulary))], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            words[rng.randint(0, len(words)) :] = rng.choice((["in", "New", "York", "City"], ["Of", "the", "the", "the", "the"], ["once", "upon", "a"]))
        texts.append("".join(w + rng.choice(("  ", " ", "\t", ". ", ",", "\n", " ", " ")) for w in words))
    rows = [(rng.choice(("en", "en", "en", "fr", None, "und", "")), t) for t in texts]
    rows += [("en", None), (None, None), ("xx", ""), ("xx", " \n.,"), ("yy", "one two"), ("en", texts[3]), ("en", texts[3])]
    rows += [("zz", "ha " * 20_000 + "hm " * 7)]  # one long text
    return rows


ROWS = corpus()


def frame(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(*r, 1, "c") for r in rows], "lang string, text string, n int, chunk string")


@pytest.mark.parametrize("least, longest, chunk, broadcast", [(5, 4, 700, True), (5, 4, 1 << 20, True), (2, 3, 3000, False), (30, 5, 3000, True)])
def test_collocations(spark, monkeypatch, least, longest, chunk, broadcast):
    if not broadcast:
        plain = phrases.lookup_join
        monkeypatch.setattr(phrases, "lookup_join", lambda *a, **k: plain(*a, **k, broadcast_bytes=-1))
    got = phrases.collocations(frame(spark, ROWS).repartition(3), least, longest, chunk_bytes=chunk, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute.collocations(ROWS, least, longest, top=40)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) >= 8


def test_nothing(spark):
    assert phrases.collocations(frame(spark, ROWS).where("false")).count() == 0
    assert phrases.collocations(frame(spark, [("en", None), (None, "a b")])).count() == 0


def test_tiles_are_counted_densely_and_sparsely():
    rng = np.random.default_rng(1)
    left = np.concatenate((rng.integers(0, 200, 50_000), rng.integers(0, 5000, 5000)))
    right = np.concatenate((rng.integers(0, 250, 50_000), rng.integers(0, 5000, 5000)))
    got = phrases.tile_counts(left, right, 5000)
    key, count = np.unique(left * 5000 + right, return_counts=True)
    assert sorted(zip(*(x.tolist() for x in got))) == list(zip((key // 5000).tolist(), (key % 5000).tolist(), count.tolist()))
    none = np.empty(0, dtype=np.int64)
    assert [len(x) for x in phrases.tile_counts(none, none, 1)] == [0, 0, 0]


def test_blocks_hold_all_sizes():
    columns = [np.array(x, dtype=np.int64) for x in ([0, 255, 3], [65535, 1, 0], [65536, 2**32 - 1, 7], [2**62, 0, 1])]
    assert [c.tolist() for c in phrases._unblock(phrases._block(*columns))] == [c.tolist() for c in columns]
    assert phrases._ids(phrases._stream(np.array([5, -1, 2**40]))).tolist() == [5, -1, 2**40]
    assert [len(c) for c in phrases._unblock(phrases._block(np.empty(0, dtype=np.int64)))] == [0]


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**18
    level = spark.createDataFrame([("en", 1, "a b", [big, big - 1], [big, big - 1])], "lang string, id long, phrase string, begins array<long>, ends array<long>")
    row = phrases._judged(level, 2).first()
    assert row.score == 2_000_000 * (big - 1) // (2 * big) and (row.l, row.r, row.a) == (big, big, big - 1)


def test_query(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_collocations(spark, DATA).collect()))
    assert got == brute.collocations(rows) and got
