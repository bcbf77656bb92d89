"""Token ids of many texts at once, exactly as the tokenizer gives them.

A byte-level BPE never merges across the pieces that its pattern cuts a text into, so
each distinct piece is encoded once and remembered.  Texts with characters on
which pattern libraries could differ, or with a special token's string, are encoded whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd

from oreline.llm.words import text_hashes

#: Pieces in each of the two generations that a worker remembers.
MEMO = 400_000
#: Code points handled at once.
GROUP = 1 << 21

#: The pattern this module cuts by, as ``pre_tokenizer`` ByteLevel has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Ranges of characters whose classes have long been settled.
SETTLED = (
    (0x0009, 0x000D),
    (0x0020, 0x007E),
    (0x00A0, 0x024F),
    (0x0391, 0x03A1),
    (0x03A3, 0x03C9),
    (0x0400, 0x045F),
    (0x05D0, 0x05EA),
    (0x2010, 0x2027),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FA5),
    (0xAC00, 0xD7A3),
)
OTHER, LETTER, NUMBER, BLANK, UNSETTLED = range(5)


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(1 << 16, UNSETTLED, dtype=np.uint8)
    for low, high in SETTLED:
        for c in range(low, high + 1):
            kind = unicodedata.category(chr(c))[0]
            blank = chr(c).isspace()
            table[c] = (
                BLANK if blank else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
            )
    return table


def piece_starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which positions start a piece; ``first`` marks the first position of a text."""
    kind = _classes()[code]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    # The last blank before a word goes with it if it is a space, else stands alone.
    after = np.flatnonzero(begins[1:] & ~blank[1:] & blank[:-1] & ~first[1:]) + 1
    begins[after - 1] = True
    begins[after[code[after - 1] == 32]] = False
    # 's 't 'm 'd 're 've 'll
    marks = np.flatnonzero(begins & (code == 39))
    marks = marks[marks + 1 < len(code)]
    marks = marks[~first[marks + 1]]
    following = code[marks + 1]
    short = marks[np.isin(following, [ord(c) for c in "stmd"])]
    two = marks[marks + 2 < len(code)]
    two = two[~first[two + 2]]
    pair = code[two + 1].astype(np.int64) << 16 | code[two + 2]
    long = two[np.isin(pair, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])]
    for at, n in ((short, 2), (long, 3)):
        begins[at + 1] = False
        rest = at + n
        begins[rest[rest < len(code)]] = True
    return begins


class Encoder:
    """Encodes lists of texts; one per worker, see :func:`encoder`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        cut = given.get("pre_tokenizer") or {}
        self.by_pieces = (
            given["model"]["type"] == "BPE"
            and not given["model"].get("dropout")
            and given.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
        )
        self.special = [t["content"] for t in given.get("added_tokens", [])]
        #: Ids by piece.  What is asked for moves to the young generation; the old one is dropped as a whole.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4")

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yields (first text, ids per text, ids) for runs of texts; null is empty."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < GROUP):
                size += len(texts[end] or "")
                end += 1
            yield (at, *self._group([t or "" for t in texts[at:end]]))
            at = end

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        joined = "".join(texts)
        if not joined:
            return np.zeros(len(texts), dtype=np.int64), np.empty(0, dtype="<u4")
        code = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        edges = np.concatenate(([0], np.cumsum(sizes)))
        odd = np.zeros(len(texts), dtype=bool)
        if self.by_pieces:
            wide = code > 0xFFFF
            unsettled = wide | (_classes()[np.where(wide, 0, code)] == UNSETTLED)
            odd[np.searchsorted(edges, np.flatnonzero(unsettled), side="right") - 1] = True
            if any(s in joined for s in self.special):
                odd |= np.array([any(s in t for s in self.special) for t in texts])
        else:
            odd[:] = True
        if not odd.any():
            return self._pieces(joined, code, edges)
        plain = np.flatnonzero(~odd)
        counts, parts = np.zeros(len(texts), dtype=np.int64), [None] * len(texts)
        if len(plain) and sizes[plain].sum():
            n, ids = self._group([texts[i] for i in plain])
            ends = np.cumsum(n)
            for i, a, b in zip(plain, ends - n, ends):
                parts[i], counts[i] = ids[a:b], b - a
        for i in np.flatnonzero(odd):
            parts[i] = self.whole(texts[i])
            counts[i] = len(parts[i])
        kept = [p for p in parts if p is not None]
        return counts, np.concatenate(kept) if kept else np.empty(0, dtype="<u4")

    def _pieces(self, joined, code, edges) -> tuple[np.ndarray, np.ndarray]:
        first = np.zeros(len(code), dtype=bool)
        first[edges[:-1][edges[:-1] < edges[1:]]] = True
        start = np.flatnonzero(piece_starts(code, first))
        end = np.append(start[1:], len(code))
        # Hashes only bring equal pieces of this group together; the memo goes by the pieces themselves.
        which, distinct = pd.factorize(text_hashes(code.astype(np.uint16), start, end))
        sample = np.empty(len(distinct), dtype=np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]  # its first place is written last
        names = [joined[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())]
        coded = self._coded(names)
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        n = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        begin = np.cumsum(n) - n
        each = n[which]
        done = np.cumsum(each)
        ids = flat[np.repeat(begin[which] - done + each, each) + np.arange(done[-1])]
        upto = np.concatenate(([0], done))[np.searchsorted(start, edges)]
        return np.diff(upto), ids


    def _coded(self, names: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        coded = list(map(self.young.get, names))
        missing = [i for i, c in enumerate(coded) if c is None]
        if len(self.young) + len(missing) > MEMO:
            self.young, self.old = {}, self.young
        unknown = []
        for i in missing:
            coded[i] = known = self.old.get(names[i])
            if known is None:
                unknown.append(i)
            else:
                self.young[names[i]] = known
        found = self.tokenizer.encode_batch_fast([names[i] for i in unknown], add_special_tokens=False)
        if unknown:
            ids = [e.ids for e in found]
            flat = np.fromiter(itertools.chain.from_iterable(ids), dtype="<u4").tobytes()
            at = 0
            for i, own in zip(unknown, ids):
                end = at + 4 * len(own)
                coded[i] = self.young[names[i]] = flat[at:end]
                at = end
        return coded


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
