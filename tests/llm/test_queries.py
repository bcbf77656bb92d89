"""Each registered query over the smallest tables against a plain version."""

from __future__ import annotations

import math
import zlib

import pytest

import __spark_entry__
from oreline.llm import decontaminate, packing, queries
from oreline.llm.tokens import Encoder
from tests.conftest import DATA
from tests.llm import brute

NAMES = [
    "op1_token_store", "op2_packing", "op3_language_id", "op4_line_dedup", "op5_decontaminate", "op6_near_dedup", "op7_ann",
    "op8_substring_dedup", "op9_secrets", "op10_url_filter", "op11_collocations", "op12_periodic_runs", "op13_chat_format",
]


@pytest.fixture(scope="module")
def pairs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(queries.tokenizer_path())


def test_registered():
    assert {*NAMES, "pipeline"} <= set(__spark_entry__.queries())
    assert list(queries.QUERIES) == NAMES and set(queries.ORACLES) <= set(NAMES)


def test_op1(spark, pairs, encoder):
    got = queries.op1_token_store(spark, DATA).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == brute.token_store(pairs, encoder.tokenizer)


def test_op2(spark, pairs, encoder):
    ids = {d: encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in pairs}
    rows = queries.op2_packing(spark, DATA).collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(
        (d, i, a, n, brute.crc(v[a : a + n])) for d, v in ids.items() for i, (a, n) in enumerate(packing.cut(len(v), 2048))
    )
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048
    # documents of each task are packed by themselves: one sequence more for each
    tasks = len({s >> 40 for s in placed})
    assert len(placed) <= 1.02 * math.ceil(sum(map(len, ids.values())) / 2048) + tasks


def test_op3_holds_out_a_fold(spark, pairs):
    rows = queries.op3_language_id(spark, DATA).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in pairs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)


def test_op4(spark, pairs):
    got = queries.op4_line_dedup(spark, DATA)
    expected = sorted((d, n, gone, brute.sha(t)) for d, n, gone, t in brute.line_dedup(pairs))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == expected


def test_op5(spark, pairs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op5_decontaminate(spark, DATA).collect()}
    expected = brute.passages(pairs, items)
    # documents shorter than the item are compared as a whole, which the plain version does not do
    short = {d for d, t in pairs if len(brute.plain_words(t)) < max(len(brute.plain_words(t)) for _, t in items)}
    assert expected.keys() <= got.keys() and all(got[p] == s for p, s in expected.items())
    assert {d for d, _ in got.keys() - expected.keys()} <= short
    assert decontaminate.find_passages(spark.createDataFrame(pairs, "doc_id bigint, text string").where("false"), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


def test_op6(spark, pairs):
    got = queries.op6_near_dedup(spark, DATA).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == brute.near_dedup(pairs, 2)


def test_op7(spark):
    import numpy as np

    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    expected = brute.nearest(vectors, [i for i in vectors if i % 50 == 0])
    found = {}
    for r in queries.op7_ann(spark, DATA).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert all(len(found[q]) == 5 for q in expected)
    hits = sum(len(found[q].keys() & {i for i, _ in e}) for q, e in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
    assert all(found[q][i] == pytest.approx(s, abs=1e-12) for q, e in expected.items() for i, s in e if i in found[q])


def test_op8(spark, pairs):
    got = queries.op8_substring_dedup(spark, DATA)
    expected = sorted((d, n, gone, brute.sha(t)) for d, n, gone, t in brute.substring(pairs))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == expected


def test_op9(spark, pairs):
    kinds = ("assign", "access", "hex")
    texts = dict(pairs)
    for r in queries.op9_secrets(spark, DATA).collect():
        base = brute.secrets(texts[r.doc_id])
        listed = [f"{kind}:{start}:{end}" for start, _, kind, end in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[2] == k for b in base) for k in kinds)
        assert r.base_sha256 == brute.sha(",".join(listed))
        assert [s for s in r.spans.split(",") if s.split(":")[0] in kinds] == listed
