"""Lines of rows that share a doc_id."""

from __future__ import annotations

from oreline.llm import line_dedup


def test_repeated_rows_count_as_one_document(spark):
    line = "a line of more than forty code points, in two documents"
    rows = [(1, line)] * 4 + [(2, line)]
    got = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_dropped, r.kept_text) for r in got) == [(d, 0, t) for d, t in rows]
    often = rows + [(d, line) for d in (3, 4, 5)]
    got = line_dedup.deduplicate_lines(spark.createDataFrame(often, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in got) == [(1, 1)] * 4 + [(2, 1), (3, 1), (4, 1), (5, 0)]


def test_rows_that_share_an_id_lose_their_own_lines(spark):
    common, own = "a line that five documents hold, of forty chars", "a line that stands in one document only, kept"
    rows = [(i, common) for i in range(10, 15)]
    rows += [(1, f"x\n{common}\ny"), (1, f"x\n{own}\ny"), (1, None), (None, common)]
    odd = spark.createDataFrame([(*r, 5, "t") for r in rows], "doc_id bigint, text string, n_dropped int, _lines string")
    got = line_dedup.deduplicate_lines(odd)
    assert got.columns == ["doc_id", "text", "_lines", "n_lines", "n_dropped", "kept_text"]
    kept = sorted(((r.doc_id or 0, r.n_dropped, r.kept_text) for r in got.collect()))
    assert kept == sorted(
        [(0, 0, common), (1, 1, "x\ny"), (1, 0, f"x\n{own}\ny"), (1, 0, "")] + [(i, int(i < 14), "" if i < 14 else common) for i in range(10, 15)]
    )
