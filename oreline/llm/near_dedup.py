"""Near-duplicate groups: SuperMinHash, banding, exact verification, union-find.

1. Each document becomes its set of word shingles (64-bit hashes), a 128-bit fingerprint of that
   set and a SuperMinHash signature, cut into bands.
2. Documents with equal sets collapse into one, so groups of copies of any size go on as one row.
3. Buckets with the same members are taken once.  Each document is paired with the smallest id it meets; pairs are verified on the
   full sets; union-find gives components.  Then members are paired with the smallest id of
   their other buckets, where the two are not yet connected.
4. In buckets that still hold several components, members are compared block by block by parity sketches, which
   give a sure lower bound of the difference of two sets.  Only pairs that the bound cannot rule out leave
   the tasks and are verified, so no link among candidates is lost and no group is expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.words import SMALL_GROUP, Words, mix, run_hashes, tidied, words
from oreline.operators.joins import lookup_join
from oreline.session import materialize

SEED = np.uint64(0x5851F42D4C957F2D)
#: Elements handled at once.
CHUNK = 1 << 14
#: Members of a bucket that are compared at once with as many others.
BLOCK = 1024


def shingle_sets(group: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered by row and hash.

    A row with fewer than ``k`` words, but one at least, has its whole sequence as its shingle.
    """
    at = group.runs(k)
    row, h = group.row[at], run_hashes(group.hash, at, k)
    bounds = group.bounds()
    n = np.diff(bounds)
    for size in range(1, k):
        few = np.flatnonzero(n == size)
        if len(few):
            row = np.concatenate((row, few))
            h = np.concatenate((h, run_hashes(group.hash, bounds[few], size)))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def super_minhash(row: np.ndarray, elements: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """Signatures of ``m`` values for the sets given as ordered (row, element) pairs.

    Each element draws a permutation of the m slots, one rank per round, and
    a uniform number r per rank j; a slot's value is the least j + r over the elements.
    Values drawn in round j are below j + 1, so a set is done as soon as each of its slots
    was drawn: later rounds could only bring larger ones.  Rows without elements keep infinity.
    """
    values = np.full((n_rows, m), np.inf)
    bounds, first = np.searchsorted(row, np.arange(n_rows + 1)), 0
    while first < n_rows:
        last = int(np.searchsorted(bounds, bounds[first] + CHUNK, side="right")) - 1
        last = min(n_rows, max(first + 1, last))
        a, b = int(bounds[first]), int(bounds[last])
        # A set that is larger by itself goes in parts, whose values combine by their least.
        for low in range(a, b, CHUNK):
            part = slice(low, b if last - first > 1 else min(low + CHUNK, b))
            some = np.full((last - first, m), np.inf)
            _signatures(row[part] - first, elements[part], some, m)
            np.minimum(values[first:last], some, out=values[first:last])
            if part.stop == b:
                break
        first = last
    return values


def _signatures(row: np.ndarray, elements: np.ndarray, values: np.ndarray, m: int) -> None:
    n = len(row)
    if not n:
        return
    perm = np.tile(np.arange(m, dtype=np.uint16), (n, 1))
    flat, own = values.reshape(-1), np.arange(n)
    active, state = own, elements ^ SEED
    for j in range(m):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        r = (state >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = j + ((mix(state ^ SEED) >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(
            np.int64
        )
        slot = perm[active, pick].copy()
        perm[active, pick] = perm[active, j]
        perm[active, j] = slot
        np.minimum.at(flat, row[active] * m + slot, j + r)
        if j + 1 == m:
            break
        going = (values >= j + 1).any(axis=1)[row[active]]
        if not going.any():
            break
        active, state = active[going], state[going]


def sketch(docs: DataFrame, k: int, bands: int, rows: int, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (fingerprint of the set) and bands (null for an empty set)."""
    m = bands * rows
    salts = mix(np.arange(1, m + 1, dtype=np.uint64))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for group in words(batch.column("text"), lower=lower, size=SMALL_GROUP):
                row, h = shingle_sets(group, k)
                n = np.bincount(row, minlength=group.n_rows)
                f1 = np.zeros(group.n_rows, dtype=np.uint64)
                f2 = np.zeros(group.n_rows, dtype=np.uint64)
                np.add.at(f1, row, mix(h ^ np.uint64(0x1B873593)))
                np.add.at(f2, row, mix(h + np.uint64(0xCC9E2D51)))
                values = super_minhash(row, h, group.n_rows, m)
                some = n > 0
                values[~some] = 0
                bits = mix(values.view(np.uint64) * salts)
                bits = mix(bits.reshape(group.n_rows, bands, rows).sum(axis=2, dtype=np.uint64))
                edges = np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(group.first_row, group.n_rows),
                        pa.array(n.astype(np.int64)),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(edges), pa.array(bits[some].reshape(-1).view(np.int64))
                        ),
                    ],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        tidied(make), "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>"
    )


def full_sets(docs: DataFrame, k: int, lower: bool = True) -> DataFrame:
    """doc_id, its shingle hashes, ordered, as the bytes of 64-bit integers, and their :func:`parities`."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for group in words(batch.column("text"), lower=lower, size=SMALL_GROUP):
                row, h = shingle_sets(group, k)
                edges = np.searchsorted(row, np.arange(group.n_rows + 1))
                sets = [h[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                sums = parities(row, h, np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(group.first_row, group.n_rows),
                        pa.array(np.diff(edges).astype(np.int64)),
                        pa.array(sets, type=pa.binary()),
                        pa.array(sums, type=pa.binary()),
                    ],
                    names=["doc_id", "n", "shingles", "parity"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        tidied(make), "doc_id bigint, n bigint, shingles binary, parity binary"
    )


def parities(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A parity sketch for each row's set: every shingle flips one bit.

    The bits in which two sketches differ are at most as many as the shingles that only one of the sets has.
    A sketch has a power of two of bits, four to eight for each shingle; a longer one folds to a shorter.
    """
    longs = 1 << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / 16))).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(longs)))
    at = mix(h ^ np.uint64(0x6C62272E07BB0142)) & (longs[row] * 64 - 1).astype(np.uint64)
    flat = np.zeros(first[-1], dtype=np.uint64)
    bit = np.uint64(1) << (at & np.uint64(63))
    np.bitwise_xor.at(flat, first[row] + (at >> np.uint64(6)).astype(np.int64), bit)
    return [flat[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]


def folded(sketches: np.ndarray, longs: int) -> np.ndarray:
    """Sketches, one a row, at ``longs`` integers each."""
    while sketches.shape[1] > longs:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def within_reach(differ: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``total`` shingles together that differ in ``differ`` at least may reach the similarity."""
    return (100 + percent) * differ.astype(np.int64) <= (100 - percent) * total


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union, decided on the full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"), F.col("shingles").alias("sb"))
    # Sizes and sketches rule out most pairs that are too far apart, before full sets travel, and
    # sets of documents in no pair stay where they are.
    near = ("na", "pa", "nb", "pb")
    sized = (
        pairs.join(left.drop("sa"), "a")
        .join(right.drop("sb").join(pairs.select("b"), "b", "left_semi"), "b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .select("a", "b", *near)
    )

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            for i, pair in enumerate(
                zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())
            ):
                x, y = (np.frombuffer(p, dtype=np.uint64)[None, :] for p in pair)
                longs = min(x.shape[1], y.shape[1])
                differ = np.bitwise_count(folded(x, longs) ^ folded(y, longs)).sum()
                keep[i] = within_reach(differ, na[i] + nb[i], percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sifted = materialize(sized.mapInArrow(tidied(sift), "a bigint, b bigint"), "sifted")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(
                zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            ):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return (
        sifted.join(left.drop("na", "pa"), "a")
        .join(right.drop("nb", "pb").join(sifted.select("b"), "b", "left_semi"), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(tidied(compare), "a bigint, b bigint")
    )


def _forest(edges: DataFrame) -> DataFrame:
    """Union-find over each partition's edges: (node, root) for every node that is not its root."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while up.setdefault(top, top) != top:
                top = up[top]
            while up[x] != top:
                up[x], x = top, up[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        tree = [(x, root(x)) for x in list(up)]
        tree = [t for t in tree if t[0] != t[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t[i] for t in tree], type=pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    return edges.select("a", "b").mapInArrow(tidied(unite), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge.

    Union-find within partitions leaves a forest of at most one edge per node and partition; then
    labels take the least of their neighbours' and jump to their label's label until none changes.
    Each round is written to the shared folder; the driver sees one count per round.
    """
    forest = materialize(_forest(edges), "forest")
    both = materialize(
        forest.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            forest.select("b", "a")
        ),
        "links",
    )
    labels = materialize(
        both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels"
    )
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("root").alias("r"))
        least = both.join(seen, "other").groupBy("node").agg(F.min("r").alias("r"))
        lower = (
            labels.join(least, "node")
            .select("node", F.least("root", "r").alias("new"), F.col("root").alias("old"))
        )
        # The old root hears of the new one, too, so that whole trees move at once.
        told = lower.where("new < old").groupBy(F.col("old").alias("n2")).agg(F.min("new").alias("t"))
        moved = materialize(
            lower.join(told, F.col("node") == F.col("n2"), "left").select(
                "node", F.least("new", "t").alias("new"), "old"
            ),
            "labels",
        )
        jump = moved.select(F.col("node").alias("j"), F.col("new").alias("jr"))
        after = materialize(
            moved.join(jump, moved.new == jump.j, "left").select(
                "node", F.least("new", "jr").alias("root"), "old"
            ),
            "labels",
        )
        if after.where("root <> old").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
    lower: bool = True,
) -> DataFrame:
    """Groups of ``docs`` (doc_id, text; others ignored) linked by word-shingle similarity.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included) and kept
    (doc_id = component_id).  ``lower`` folds A-Z.  Texts that are null or without words have an empty set and no
    links.  Each row gives a row; rows that share a doc_id share its fate.  A row without a doc_id
    has a null component and is kept.  A pair at the limit of 80 % is missed by all 40 bands of
    6 with a probability of 5e-6, and more similar ones less often.
    """
    sketched = materialize(sketch(docs, k, bands, rows, lower), "sketches")
    own = sketched.where("doc_id is not null and n_shingles > 0")
    reps = materialize(own.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "sets")
    # The representative's own row brings the bands; copies do not come along.  Bands mix salts of
    # their own, so a value names its band, too.
    members = own.join(
        reps.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi"
    ).select("doc_id", F.explode("bands").alias("value"))
    # Most values belong to one document: three numbers a value are all that travels to find the others.
    met = materialize(
        members.groupBy("value")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select("value", "low"),
        "met",
    )
    meeting = materialize(lookup_join(members, met, ["value"], "doc_id"), "meeting")
    company = meeting.groupBy("value").agg(
        F.min("low").alias("low"),
        F.max("doc_id").alias("high"),
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "doc_id")).alias("x2"),
    )
    # Documents that meet in many bands meet in the same company: one bucket of each is enough.
    shared = materialize(
        company.groupBy("low", "high", "n", "x1", "x2")
        .agg(F.min("value").alias("value"))
        .select("value", "n"),
        "buckets",
    )
    crowded = materialize(lookup_join(meeting, shared, ["value"], "doc_id"), "members")
    # Texts stay where they are while the ids that meet others are few enough to be sent to them.
    wanted = materialize(crowded.select("doc_id").distinct(), "wanted")
    sets = materialize(
        full_sets(lookup_join(docs.select("doc_id", "text"), wanted, ["doc_id"], "doc_id"), k, lower),
        "shingles",
    )
    # First one pair per document, with the smallest it meets; then the smallest of its other buckets.
    stars = crowded.where("low < doc_id").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    done = materialize(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    links = materialize(verified(done, sets, percent), "links")
    found = components(links)
    for next_pairs in (_other_stars, _unconnected):
        rest = materialize(
            next_pairs(crowded, found, sets, percent).join(done, ["a", "b"], "left_anti"), "rest"
        )
        if rest.isEmpty():
            continue
        done = done.union(rest)
        more = materialize(verified(rest, sets, percent), "links")
        if not more.isEmpty():
            links = links.union(more)
            found = components(links)
    grouped = (
        reps.join(found, F.col("rep") == F.col("node"), "left")
        .select("f1", "f2", F.coalesce("root", "rep").alias("component"))
    )
    return (
        sketched.select("doc_id", "n_shingles", "f1", "f2")
        .join(grouped, ["f1", "f2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")
            ).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _rooted(pairs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``pairs`` with the component of column ``name``, itself where it has no link."""
    roots = found.select(F.col("node").alias(name), F.col("root").alias("r"))
    return pairs.join(roots, name, "left").withColumn("r" + name, F.coalesce("r", name)).drop("r")


def _other_stars(crowded: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a member and its bucket's smallest that are in different components."""
    pairs = crowded.where("low < doc_id").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    placed = _rooted(_rooted(pairs.distinct(), found, "a"), found, "b")
    return placed.where("ra <> rb").select("a", "b")


def _unconnected(crowded: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket in different components that may reach the similarity.

    A bucket's members are dealt into blocks and every two blocks meet in one task, which holds 2 * BLOCK members at most.
    """
    placed = materialize(
        _rooted(crowded.where("n > 2").select("value", "doc_id"), found, "doc_id")
        .withColumnRenamed("rdoc_id", "root"),
        "placed",
    )
    sizes = placed.groupBy("value", "root").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("value")
        .agg(F.count("*").alias("c"), F.sum("n").alias("members"))
        .where("c > 1")
        .select("value", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    )
    dealt = (
        placed.join(materialize(mixed, "mixed"), ["value"])
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "root"
        )
    )
    sketched = dealt.join(sets.select("doc_id", "n", "parity"), "doc_id")

    def compare(table: pa.Table) -> pa.Table:
        own = table["own"].to_numpy()
        low, high = table["i"][0].as_py(), table["j"][0].as_py()
        doc, root, n = (table[c].to_numpy() for c in ("doc_id", "root", "n"))
        flat = [np.frombuffer(p, dtype=np.uint64) for p in table["parity"].to_pylist()]
        longs = np.array([len(p) for p in flat])
        levels = {
            w: (np.flatnonzero(longs == w), np.stack([p for p in flat if len(p) == w])) for w in np.unique(longs)
        }
        a, b = [], []
        for w, (rows, sketches) in levels.items():
            for v, (others, theirs) in levels.items():
                near = folded(theirs, min(w, v))
                for at, sketch_ in zip(rows, folded(sketches, min(w, v))):
                    if own[at] != low:
                        continue
                    able = (root[others] != root[at]) & (own[others] == high)
                    able &= 100 * np.minimum(n[others], n[at]) >= percent * np.maximum(n[others], n[at])
                    able = np.flatnonzero(able)
                    differ = np.bitwise_count(near[able] ^ sketch_).sum(axis=1)
                    hits = others[able[within_reach(differ, n[others[able]] + n[at], percent)]]
                    a.append(np.minimum(doc[hits], doc[at]))
                    b.append(np.maximum(doc[hits], doc[at]))
        return pa.table(
            {
                name: pa.array(np.concatenate([np.empty(0, dtype=np.int64), *x]))
                for name, x in (("a", a), ("b", b))
            }
        )

    return (
        sketched.groupBy("value", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()
    )
