"""Secrets that hold a pattern of the allow-list by accident or beside them."""

from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from oreline.llm import secret_scan  # noqa: E402
from oreline.llm.ship import ship_package  # noqa: E402

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
TOKEN = "q7Zk29xPLm4TvR81nWcY6bHs"


def spans(spark, texts):
    ship_package(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "high_base64"]
           for r in secret_scan.find_secrets(docs).collect()}
    return [got[i] for i in range(len(texts))]


def test_long_random_base64(spark):
    rng = random.Random(21)
    texts = []
    for n in (40, 88, 400, 1600):
        for i in range(40):
            text = [rng.choice(ALPHABET) for _ in range(n)]
            if i % 2:  # with "//", or a short path, or a word in it
                put = ("//", "/ab/c1/", "/sample/")[i % 3] if n > 80 else "//"
                at = rng.randrange(n - len(put))
                text[at : at + len(put)] = put
            texts.append("".join(text))
    c = secret_scan.CLASSES[1]
    expected = [brute.entropy_span(t, c.window, c.bits) for t in texts]
    assert all(expected)
    assert spans(spark, texts) == [[e] for e in expected]


def test_tokens_beside_paths_and_words(spark):
    beside = ["com/v1/reset/", "//localhost/", "my-sample-svc_", "/usr/lib/x/", "data-", "data/img/", "dummy-"]
    for text, found in zip(beside, spans(spark, [b + TOKEN for b in beside])):
        [(low, high)] = found
        assert low <= len(text) and high == len(text) + len(TOKEN), text


def test_no_secrets(spark):
    texts = [
        "//www/Downloads/MyPhotos2023/Summer/Beach/index1",
        "/home/user/Projects/Website/build/Main2/README",
        "data-toggle-Widget-Number7/left/Quick/Jumps",
        "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        "placeholder-Qx7-changeme-Zk2-redacted",
        "3f2504E0-4f89-41D3-9a0c-0305E82C3301",
    ]
    assert spans(spark, texts) == [[]] * len(texts)


def test_long_candidates_and_many_matches(spark):
    """Neither ends the JVM nor takes time with the square of the matches."""
    import time

    rng = random.Random(4)
    texts = [
        "Ab-" * 4000 + "x9",
        "Ab-" * 300_000 + "x",
        "a/" * 500_000,
        "aB" * 300_000 + "9",
        "".join(rng.choice(ALPHABET) for _ in range(1 << 20)),
        "é " + f"AKIA{'Z' * 12} " * 100_000,
        "0123456789abcdef" * 65_536,
    ]
    ship_package(spark)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string, _hex string")
    began = time.time()
    found = secret_scan.find_secrets(docs.repartition(7))
    assert found.columns == ["doc_id", "text", "_hex", "spans"]
    got = {r.doc_id: r.spans for r in found.select("doc_id", "spans").collect()}
    assert time.time() - began < 120
    assert [len(got[i]) for i in (0, 1, 2, 3)] == [0, 0, 0, 0]
    assert [(s.start, s.end) for s in got[4] if s.kind == "high_base64"] == [(0, 1 << 20)]
    assert [(s.start, s.end) for s in got[5] if s.kind == "access"] == [(2 + 17 * i, 18 + 17 * i) for i in range(100_000)]
    assert [(s.start, s.end) for s in got[6] if s.kind == "hex"] == [(0, 1 << 20)]
