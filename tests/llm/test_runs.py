"""Periodic runs against a scan of every lag."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from oreline.llm import queries, runs
from oreline.llm.ship import ship_package
from oreline.llm.words import mix
from tests.conftest import DATA
from tests.llm import brute


def numbered(word):
    return mix(np.array(word, dtype=np.uint64) + np.uint64(5))


def sequences():
    rng = random.Random(3)
    for _ in range(400):
        n, kinds = rng.randint(0, 160), rng.randint(1, 4)
        word = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 10:
                a, p = rng.randrange(n), rng.randint(1, 14)
                word[a:] = [word[a + i % p] if a + i % p < n else 0 for i in range(n - a)]
        for _ in range(rng.choice((0, 0, 3))):
            if n:
                word[rng.randrange(n)] = rng.randrange(6)
        yield word, rng.choice((24, 6))


def test_runs_of_short_alphabets():
    total = 0
    for word, least in sequences():
        found = runs.find_runs(np.zeros(len(word), dtype=np.int64), numbered(word), 1, least)[0]
        expected = brute.periodic_runs(word, least)
        assert found.runs == expected
        total += len(expected)
    assert total > 200


def test_texts_do_not_touch():
    word = numbered([1] * 20 + [1] * 20 + [2] * 30)
    row = np.array([0] * 20 + [1] * 20 + [3] * 30)
    assert [f.runs for f in runs.find_runs(row, word, 4)] == [[], [], [], [(0, 30, 1)]]


def test_splitting_goes_on_until_nothing_changes():
    # 7 stands three times, but only twice once 9 has split the segment; then 8 is rare, too
    word = [7, 8, 7, 8] + [1, 2] * 3 + [9] + [7, 8] + [1, 2] * 13
    start, end = runs.segments(np.zeros(len(word), dtype=np.int64), numbered(word))
    assert list(zip(start, end)) == [(13, 39)]


def test_long_sequences():
    thue_morse = np.zeros(1, dtype=np.int64)
    while len(thue_morse) < 1 << 15:
        thue_morse = np.concatenate((thue_morse, 1 - thue_morse))
    one = np.zeros(200_000, dtype=np.int64)
    for word, expected in ((thue_morse, []), (one, [(0, 200_000, 1)])):
        assert runs.find_runs(np.zeros_like(word), numbered(word), 1)[0].runs == expected


def test_wrong_fingerprints_are_noticed():
    word = numbered([1, 2] * 20 + [3] + [1, 2] * 30)
    assert runs._checked(word, 0, len(word), 2) == (41, 101)
    assert runs._checked(word, 0, 40, 2) == (0, 40)


@pytest.fixture(scope="module")
def texts(spark):
    ship_package(spark)
    rows = [
        (1, "a b " * 20 + "c"), (1, "a b " * 20 + "c"), (2, None), (3, ""), (None, "x\t" * 30), (4, " \n "),
        (5, "A a " * 12), (6, "q" * 100_000), (7, "z " * 23), (8, ("é 中 😀 " * 9) + ("m n " * 12)),
        (9, " ".join(str(i % 997) for i in range(30_000))),
    ]
    return spark.createDataFrame([(*r, "n", [1]) for r in rows], "doc_id bigint, text string, n_words string, runs array<int>")


def test_collapse(texts):
    got = runs.collapse_runs(texts).collect()
    expected = []
    for row in texts.collect():
        word = brute.WORD.findall(row.text or "")
        found = brute.periodic_runs(word, 24)
        keep = brute.without_repeats(word, found)
        expected.append((row.doc_id, len(word), found, brute.strongest(found), len(word) - len(keep), " ".join(keep)))
    seen = [
        (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.n_dropped, r.collapsed_text)
        for r in got
    ]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)
    assert runs.collapse_runs(texts.where("false")).count() == 0


def test_query(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for row in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        word = brute.WORD.findall(row.text or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(word)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            word = [word[i if i < a else a + (i - a) % p] for i in range(n)]
        found = brute.periodic_runs(word, 24)
        best = brute.strongest(found) or (None, None, None)
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
        expected.append(
            (row.doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], sha(listed), sha(" ".join(brute.without_repeats(word, found))))
        )
    got = queries.op12_periodic_runs(spark, DATA)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert sum(e[1] for e in expected) > 10
