"""Plain versions of the operators, by other means, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def token_store(docs, tokenizer, end=2):
    out, start = [], 0
    for doc, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def line_dedup(docs, least=40, often=5):
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[ascii_lower(line.strip(BLANKS))].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = ascii_lower(line.strip(BLANKS))
            if len(key) < least or len(holders[key]) < often or max(holders[key]) == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def shingles(text, k):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_dedup(docs, k, percent=80):
    """Every pair that shares a shingle is compared."""
    sets = {doc: shingles(text, k) for doc, text in docs}
    by_set = defaultdict(list)
    for doc in sorted(sets):
        by_set[sets[doc]].append(doc)
    up = {doc: doc for doc in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    def link(a, b):
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)

    reps, holders = [], defaultdict(list)
    for group in by_set.values():
        if sets[group[0]]:
            for other in group[1:]:
                link(group[0], other)
            reps.append(group[0])
    for i, rep in enumerate(reps):
        shared = defaultdict(int)
        for s in sets[rep]:
            for other in holders[s]:
                shared[other] += 1
            holders[s].append(rep)
        for other, n in shared.items():
            if 100 * n >= percent * (len(sets[rep]) + len(sets[other]) - n):
                link(rep, other)
    return sorted((d, len(sets[d]), root(d), root(d) == d) for d in sets)


def substring(docs, length=13):
    smallest = {}
    words = {doc: WORD.findall(text or "") for doc, text in docs}
    for doc in sorted(words):
        w = words[doc]
        for i in range(len(w) - length + 1):
            smallest.setdefault(tuple(w[i : i + length]), doc)
    out = []
    for doc, w in words.items():
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if smallest[tuple(w[i : i + length])] < doc:
                keep[i : i + length] = [False] * length
        kept = [x for x, k in zip(w, keep) if k]
        out.append((doc, len(w), len(w) - len(kept), " ".join(kept)))
    return sorted(out)


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def secrets(text):
    """Base spans (start, kind number, kind, end) of a text."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def entropy_span(match, window, bits):
    """First and last end of the windows whose entropy, computed anew each time, reaches bits."""
    hot = []
    for i in range(len(match) - window + 1):
        counts = np.unique(list(match[i : i + window]), return_counts=True)[1] / window
        if -(counts * np.log2(counts)).sum() >= bits - 1e-9:
            hot.append(i)
    return (hot[0], hot[-1] + window) if hot else None


def judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = ascii_lower(host)
    best = None
    for h, p, verdict in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(h + p), len(h)) > best[0]:
                best = ((len(h + p), len(h)), h + p, verdict)
    return (host, path, *(best[1:] if best else (None, default)))


def nearest(vectors, queries, k=5):
    """vectors: {id: array}; the exact answer."""
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    out = {}
    for q in queries:
        v = np.asarray(vectors[q], dtype=np.float64)
        score = (x * v).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((v * v).sum())
        score[ids == q] = -2
        order = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def plain_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def passages(docs, items, k=5, percent=80):
    """{(doc, item): similarity} of the best window of the item's size."""
    out = {}
    prepared = []
    for item, text in items:
        w = plain_words(text)
        if len(w) >= k:
            s = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            prepared.append((item, len(w), s, set(s)))
        elif w:
            for doc, other in docs:
                v = plain_words(other)
                if any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1)):
                    out[doc, item] = 1.0
    for doc, text in docs:
        w = plain_words(text)
        own = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
        for item, n, s, distinct in prepared:
            if not distinct.intersection(own):
                continue
            for i in range(len(w) - n + 1):
                got = own[i : i + n - k + 1]
                counts = defaultdict(lambda: [0, 0])
                for x in got:
                    counts[x][0] += 1
                for x in s:
                    counts[x][1] += 1
                both = sum(map(min, counts.values()))
                similar = both / sum(map(max, counts.values()))
                if similar * 100 >= percent:
                    out[doc, item] = max(similar, out.get((doc, item), 0))
    return out


def periodic_runs(word, least=24):
    """(start, length, period), by comparing the words with themselves at every lag."""
    found = {}
    for lag in range(1, len(word) // 3 + 1):
        i = 0
        while i + lag < len(word):
            j = i
            while j + lag < len(word) and word[j] == word[j + lag]:
                j += 1
            if j + lag - i >= max(least, 3 * lag) and j > i:
                found.setdefault((i, j + lag - i), lag)
            i = j + 1
    return sorted(((s, size, lag) for (s, size), lag in found.items()), key=lambda r: (r[0], r[2]))


def strongest(runs):
    from fractions import Fraction

    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def without_repeats(word, runs):
    gone = {i for s, size, lag in runs for i in range(s + lag, s + size)}
    return [w for i, w in enumerate(word) if i not in gone]


def collocations(rows, least=30, longest=4, covered=80, top=2000):
    """``rows``: (lang, text).  Counts every phrase as a tuple of words."""
    totals, counts = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            word = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(word)
            for m in range(1, longest + 1):
                for i in range(len(word) - m + 1):
                    counts[lang][tuple(word[i : i + m])] += 1
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        held = defaultdict(int)
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], a)
        best = []
        for p, a in often.items():
            if 100 * held[p] >= covered * a:
                continue
            score, _, l, r = min(
                (2_000_000 * a // (found[p[:k]] + found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p))
            )
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)
