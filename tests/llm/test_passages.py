"""Passages at the limit of the similarity: none may be lost before the exact check."""

from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from oreline.llm import decontaminate  # noqa: E402
from oreline.llm.ship import ship_package  # noqa: E402


def found(spark, docs, items):
    ship_package(spark)
    rows = decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ).collect()
    return {(r.doc_id, r.item_id): (r.n_words, r.similarity) for r in rows}


def prose(rng, n):
    return ["".join(rng.choice("abcdeostn") for _ in range(8)) for _ in range(n)]


#: words of the item, how many are changed, and from which word on; "ends": half of them at either end
EDITS = ((40, 4, "ends"), (49, 5, 0), (49, 5, 44), (100, 10, 0), (22, 2, "ends"), (200, 16, 92), (49, 1, 24))


def test_edge_and_block_edits_at_the_limit(spark):
    rng = random.Random(11)
    items, docs = [], []
    for i in range(40 * len(EDITS)):
        n, changed, at = EDITS[i % len(EDITS)]
        item = prose(rng, n)
        new = prose(rng, changed)
        if at == "ends":
            half = changed // 2
            copy = new[:half] + item[half : n - half] + new[half:]
        else:
            copy = item[:at] + new + item[at + changed :]
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(prose(rng, 30) + copy + prose(rng, 30))))
    expected = brute.passages(docs, items)
    assert len(expected) == len(items)
    assert {pair: s for pair, (_, s) in found(spark, docs, items).items()} == expected


def test_near_blocks_meet_all_within_the_radius(spark):
    rng = random.Random(12)
    pairs = []
    for distance in list(range(24)) * 20:
        a = rng.getrandbits(64)
        b = a ^ sum(1 << bit for bit in rng.sample(range(64), distance))
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    for radius in (11, 23):
        meets = None
        for one, near in zip(decontaminate.blocks(frame.a, radius), decontaminate.near_blocks(frame.b, radius)):
            met = decontaminate.F.array_contains(near, one)
            meets = met if meets is None else meets | met
        within = decontaminate.F.bit_count(frame.a.bitwiseXOR(frame.b)) <= radius
        assert frame.where(within).count() and not frame.where(within & ~meets).count()


def test_documents_shorter_than_the_item(spark):
    """An item less a few words, standing as a document of its own."""
    rng = random.Random(13)
    items, docs, expected = [], [], {}
    for i, n in enumerate((49, 16, 16, 100, 40, 7, 5, 22) * 6):
        item = prose(rng, n)
        cut = rng.randint(1, max(1, n // 8))
        at = rng.choice((0, n - cut, n // 2))
        copy = item[:at] + item[at + cut :]
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(copy)))
        a, b = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (copy, item))
        if a and 100 * len(a & b) >= 80 * len(a | b):
            expected[i, i] = (len(copy), len(a & b) / len(a | b))
    assert expected[0, 0] and len(expected) > 10 and not brute.passages(docs, items)
    assert found(spark, docs, items) == expected
    long, short = " ".join(prose(rng, 1000)), " ".join(prose(rng, 4))
    assert found(spark, [(1, short), (2, None), (3, "")], [(1, long), (2, short)]) == {(1, 2): (4, 1.0)}


def test_items_of_few_words(spark):
    rng = random.Random(14)
    texts = [prose(rng, 40) for _ in range(6)]
    items = [(n, " ".join(texts[0][7 : 7 + n]).upper() + "!") for n in range(1, 6)] + [(9, " ?! "), (10, None), (11, texts[1][39])]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(7, " ".join(texts[0][7:10])), (8, " ".join(texts[0][8:12])), (0, "again")]
    expected = brute.passages(docs, items)
    assert {p: s for p, (_, s) in found(spark, docs, items).items()} == expected
    assert {p for p in expected if p[0] == 7} == {(7, 1), (7, 2), (7, 3)} and (1, 11) in expected


def test_few_candidates_among_many_items_of_one_size(spark):
    """With blocks alone, most of these pairs would meet."""
    rng = random.Random(15)
    items = [(i, " ".join(prose(rng, 12))) for i in range(3000)]
    docs = [(i, " ".join(prose(rng, 5) + t.split() + prose(rng, 5))) for i, t in items[::10]]
    ship_package(spark)
    got = decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i, _ in items[::10]]


def test_long_documents_need_little_memory():
    import numpy as np

    hashes = np.arange(3_000_000, dtype=np.uint64)
    starts = np.arange(0, 2_999_950, 977)
    whole = decontaminate.simhash(hashes, starts, 50)
    assert (whole[[0, 1500, -1]] == [decontaminate.simhash(hashes, starts[[i]], 50)[0] for i in (0, 1500, -1)]).all()
