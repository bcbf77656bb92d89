"""What working out trigrams holds at once."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from oreline.llm import langid


def plain_trigrams(texts: list[bytes]) -> list[int]:
    """Buckets of the trigrams of all texts, in order."""
    found = []
    for text in texts:
        folded = [0, 0, *[b if b > 127 else b | 0x20 if chr(b).isalpha() else 0 for b in text], 0, 0]
        for a, b, c in zip(folded, folded[1:], folded[2:]):
            code = a << 16 | b << 8 | c
            if code:
                found.append((code * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 48)
    return found


@pytest.mark.parametrize("block", [1, 3, 1 << 18])
def test_trigrams_in_blocks(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block, raising=False)
    texts = [b"Ab cd", b"", b"7 x", b"\xc3\xa9t\xc3\xa9", b"", b"z"]
    edges = np.cumsum([0, *map(len, texts)])
    row, bucket = langid.trigrams(np.frombuffer(b"".join(texts), dtype=np.uint8), edges)
    assert bucket.tolist() == plain_trigrams(texts)
    assert len(row) == len(bucket) and (np.diff(row) >= 0).all()
    nothing, none = langid.trigrams(np.empty(0, dtype=np.uint8), np.zeros(3, dtype=np.int64))
    assert not len(nothing) and not len(none)


def test_trigrams_of_a_group_take_little_memory():
    data = np.tile(np.frombuffer(b"some words of a text ", dtype=np.uint8), 100_000)
    edges = np.append(np.arange(0, len(data), 2100), len(data))
    tracemalloc.start()
    try:
        langid.trigrams(data, edges)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30 * len(data)
