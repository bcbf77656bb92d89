"""Nearest neighbours with randomly rotated one-bit codes.

Fit: centroids are learned by k-means on a bounded sample (``sample`` vectors, those with the least hash of
their ids), a random rotation is drawn from a seed, and the number of lists to visit is measured on the sample.  Index: every vector goes to its nearest centroid;
what remains is rotated and kept as one bit per dimension, with scalars that correct the estimate: the residual's norm and
its product with its own code.  Search: a query visits the lists of its ``probes`` nearest
centroids, and more until they hold as many others as it asks for.  Vectors of each dimension have a model of their own.  In a list, inner products are estimated from the codes; the error bound gives a lower and an upper end;
vectors whose upper end reaches the k-th best lower end are reranked by their exact cosine.

Lists are dealt in blocks of about ``block`` rows and queries likewise, so a list that holds a third of all vectors
is many groups.  No vector is left out of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import materialize


#: Dimensions that a table may mix.
DIMENSIONS = 100


@dataclass
class Model:
    """Centroids (of unit vectors), the rotation, and how many lists a query visits."""

    centroids: np.ndarray
    rotation: np.ndarray
    probes: int


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of rows that can be compared: no null, no non-finite part, not zero."""
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("float")),
    )
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.coalesce(bad, F.lit(True))
        & F.exists("embedding", lambda x: x != 0)
    )


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit(
    vectors: DataFrame,
    lists: int = 64,
    sample: int = 20_000,
    rounds: int = 12,
    recall: float = 0.96,
    trials: int = 500,
    seed: int = 7,
) -> Model | None:
    """Learns from at most ``sample`` vectors on the driver; None if there are none.

    The dimension is that of the most sampled vectors, the larger on a tie.  ``probes`` is the least number of
    lists that holds a share ``recall`` of the five nearest in the sample of ``trials`` of its vectors.  The
    sample is sparser than the table, so its neighbours are farther off, and the table's are found no less often.
    """
    rows = (
        vectors.select("embedding", F.xxhash64("vec_id").alias("h"), "vec_id")
        .orderBy("h", "vec_id")
        .limit(sample)
        .select("embedding")
        .toArrow()["embedding"]
    )
    if not len(rows):
        return None
    sizes = np.array([len(v) for v in rows])
    values, counts = np.unique(sizes, return_counts=True)
    dim = int(values[len(values) - 1 - counts[::-1].argmax()])
    x = unit(matrix(rows.combine_chunks().filter(pa.array(sizes == dim))))
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    centres = np.unique(x, axis=0)
    centres = centres[rng.permutation(len(centres))[: max(1, min(lists, len(x) // 40))]]
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    model = Model(centres, rotation, 1)
    ask = x[:trials]
    alike = ask @ x.T
    alike[np.arange(len(ask)), np.arange(len(ask))] = -np.inf
    k = min(5, len(x) - 1)
    if k:
        nearest = np.argpartition(-alike, k - 1, axis=1)[:, :k]
        homes = distances(x, model).argmin(axis=1)[nearest]
        visits = np.argsort(np.argsort(distances(ask, model), axis=1), axis=1)
        needed = np.take_along_axis(visits, homes, axis=1) + 1
        model.probes = int(np.quantile(needed, recall, method="higher"))
    return model


def distances(x: np.ndarray, model: Model) -> np.ndarray:
    """Squared distance to each centroid, less the vector's own norm."""
    return (model.centroids**2).sum(axis=1) - 2 * x @ model.centroids.T


def encode(vectors: DataFrame, model: Model) -> DataFrame:
    """vec_id, embedding, list, code (packed bits), norm and own (the residual's product with its code)."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            x = unit(matrix(batch.column("embedding")))
            near = distances(x, m).argmin(axis=1)
            rest = (x - m.centroids[near]) @ m.rotation
            norm = np.sqrt((rest * rest).sum(axis=1))
            bits = rest > 0
            own = np.abs(rest).sum(axis=1) / np.sqrt(x.shape[1])
            own = np.divide(own, norm, out=np.ones_like(own), where=norm > 0)
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("embedding"),
                    pa.array(near.astype(np.int32)),
                    pa.array([p.tobytes() for p in packed], type=pa.binary()),
                    pa.array(norm),
                    pa.array(own),
                ],
                names=["vec_id", "embedding", "list", "code", "norm", "own"],
            )

    return vectors.where(F.size("embedding") == model.rotation.shape[0]).mapInArrow(
        make,
        "vec_id bigint, embedding array<double>, list int, code binary, norm double, own double",
    )


def route(queries: DataFrame, model: Model, probes: int, sizes: dict[int, int], k: int) -> DataFrame:
    """query_id, embedding and each list to visit: the ``probes`` nearest, and more until there are ``k`` others.

    ``sizes`` are the vectors in each list.
    """
    shared = queries.sparkSession.sparkContext.broadcast(model)
    held = np.array([sizes.get(i, 0) for i in range(len(model.centroids))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            x = unit(matrix(batch.column("embedding")))
            near = np.argsort(distances(x, m), axis=1, kind="stable")
            # one of them may be the query itself
            enough = (np.cumsum(held[near], axis=1) <= k).sum(axis=1) + 1
            visits = np.minimum(np.maximum(probes, enough), len(held))
            lists = [row[:n].astype(np.int32) for row, n in zip(near, visits)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id"),
                    batch.column("embedding"),
                    pa.array(lists, type=pa.list_(pa.int32())),
                ],
                names=["query_id", "embedding", "lists"],
            )

    routed = queries.where(F.size("embedding") == model.rotation.shape[0]).mapInArrow(
        make, "query_id bigint, embedding array<double>, lists array<int>"
    )
    return routed.select("query_id", "embedding", F.explode("lists").alias("list"))


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors give equal numbers wherever they stand."""
    nx, nq = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum())
    return (x * q).sum(axis=1) / (nx * nq)


def search_block(
    model: Model, codes: pa.Table, queries: pa.Table, k: int, certainty: float
) -> list[tuple[int, int, float]]:
    """The best ``k`` of one block for each query: (query, vector, cosine)."""
    centre = model.centroids[codes["list"][0].as_py()]
    dim = len(centre)
    x = matrix(codes["embedding"])
    u = unit(x)
    ids = codes["vec_id"].to_numpy()
    norm, own = codes["norm"].to_numpy(), codes["own"].to_numpy()
    packed = np.frombuffer(b"".join(codes["code"].to_pylist()), dtype=np.uint8)
    bits = np.unpackbits(packed.reshape(len(ids), -1), axis=1, count=dim)
    signs = (bits.astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    along = u @ centre
    spread = certainty * np.sqrt(np.maximum(0.0, 1 - own**2)) / own / np.sqrt(max(1, dim - 1))
    out = []
    names = queries["query_id"].to_numpy()
    q = matrix(queries["embedding"])
    qu = unit(q)
    rest = qu - centre
    far = np.sqrt((rest * rest).sum(axis=1))
    guess = signs @ (rest @ model.rotation).T.astype(np.float32)
    for j, name in enumerate(names):
        level = along + qu[j] @ centre - centre @ centre
        estimate = norm * guess[:, j] / own + level
        slack = norm * far[j] * spread + 1e-6
        other = ids != name
        lower = np.where(other, estimate - slack, -np.inf)
        bar = np.partition(lower, len(lower) - k)[-k] if len(lower) > k else -np.inf
        chosen = np.flatnonzero(other & (estimate + slack >= bar))
        score = cosines(x[chosen], q[j])
        best = np.lexsort((ids[chosen], -score))[:k]
        out += [(int(name), int(ids[chosen[i]]), float(score[i])) for i in best]
    return out


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    model: Model,
    k: int = 5,
    probes: int | None = None,
    block: int = 4096,
    query_block: int = 2048,
    certainty: float = 3.0,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest found, ties to the smaller vec_id.

    ``vectors`` and ``queries`` have vec_id and embedding; a query is not its own neighbour.  Rows that are
    not :func:`usable`, or of another dimension than the model's, take no part; see :func:`nearest_of_all`.  A vec_id
    should be unique; repeated ones count as one, with the best score.  ``certainty`` is the width of the
    error bound in standard deviations.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(model)
    index = materialize(encode(usable(vectors), model), "codes")
    # Repeated ids count as one, here as in the result.  One row per list: bounded by the model.
    counts = index.groupBy("list").agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids"))
    counts = materialize(counts, "list-sizes")
    held = {r["list"]: r["ids"] for r in counts.collect()}
    asking = usable(queries).withColumnRenamed("vec_id", "query_id")
    routed = materialize(route(asking, model, probes or model.probes, held, k), "routes")
    sizes = counts.select("list", F.ceil(F.col("n") / block).alias("parts"))
    asked = (
        routed.groupBy("list").count().select("list", F.ceil(F.col("count") / query_block).alias("asks"))
    )
    # One row per list: bounded by the model.
    dealt = F.broadcast(materialize(sizes.join(asked, "list"), "lists"))
    # A code goes to its part, once for every block of queries; a query to its block, in every part.
    placed = (
        index.join(dealt, "list")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))
        .withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    )
    sought = (
        routed.join(dealt, "list")
        .withColumn("ask", F.pmod(F.xxhash64("query_id"), "asks"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )

    def search(key: tuple, codes: pa.Table, asks: pa.Table) -> pa.Table:
        found = []
        if codes.num_rows and asks.num_rows:
            found = search_block(shared.value, codes, asks, k, certainty)
        return pa.table(
            {
                "query_id": pa.array([f[0] for f in found], type=pa.int64()),
                "vec_id": pa.array([f[1] for f in found], type=pa.int64()),
                "score": pa.array([f[2] for f in found], type=pa.float64()),
            }
        )

    keys = ("list", "part", "ask")
    found = (
        placed.select(*keys, "vec_id", "embedding", "code", "norm", "own")
        .groupBy(*keys)
        .cogroup(sought.select(*keys, "query_id", "embedding").groupBy(*keys))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_of_all(
    vectors: DataFrame, queries: DataFrame, k: int = 5, sample: int = 20_000, **how
) -> DataFrame:
    """:func:`nearest` among the vectors of the same dimension, with a model fitted for each dimension.

    ``sample`` bounds the vectors that all models together are fitted on.  Without usable vectors there are no rows.
    """
    spark = vectors.sparkSession
    able = usable(vectors)
    dims = [r[0] for r in able.select(F.size("embedding").alias("d")).distinct().orderBy("d").limit(DIMENSIONS + 1).collect()]
    if len(dims) > DIMENSIONS:
        raise ValueError(f"more than {DIMENSIONS} dimensions")
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for dim in dims:
        own = F.size("embedding") == dim
        model = fit(able.where(own), sample=max(1, sample // len(dims)))
        found = found.union(nearest(vectors.where(own), queries.where(own), model, k, **how))
    return found
