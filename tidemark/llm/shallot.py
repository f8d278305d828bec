"""Centroid clustering: exact k-means with Shallot's bounds and sorted-neighbour search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import memory
from tidemark.llm.frames import settle
from tidemark.sources.tables import forget_settled, settled_apart

#: Components at or beyond this are out of range: squared distances of up to 128 smaller ones
#: fit a long when scaled by 1024.
LARGEST = 1 << 17
#: Bounds are floats. A bound settles a comparison only if it does by more than this share.
SLACK = 1e-9


def whole_vectors(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", *, dims: int = 64, scale: int = 1024
) -> DataFrame:
    """(id, v): floor(scale * x) of each component, as integers. Vectors that are null, have
    another length or hold null, non-finite or out-of-range components are left out."""
    vector = F.col(f"`{vector_column}`")
    # NaN compares as greater than every number.
    fit = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))
    return df.filter((F.size(vector) == dims) & fit).select(
        F.col(f"`{id_column}`").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"),
    )


def seeds(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The vectors of the k smallest sha256 of ``prefix`` and id; null ids last, equal ids by
    their components."""
    ranked = vectors.select(F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256).alias("h"), "v")
    first = ranked.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k vectors
    return np.array([r["v"] for r in first], np.int64)


@dataclass(frozen=True)
class Round:
    """What a round needs besides the vectors: k centroids and their geometry."""

    centroids: np.ndarray
    #: How far each has moved since the round before.
    moved: np.ndarray

    @property
    def apart(self) -> np.ndarray:
        c = self.centroids.astype(float)
        return np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))


def _squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def assign(v: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray, at: Round) -> None:
    """Move each vector of ``v`` to its nearest centroid, ties to the smaller number; in place.

    ``a`` is the centroid it had, ``b`` the second nearest of then, ``upper`` a bound of the
    distance to ``a`` from above, ``lower`` one of the distance to any other from below. Bounds
    are first moved by what the centroids moved. Where they do not settle a vector, the scan
    starts from the closer of ``a`` and ``b`` and takes the other centroids by their distance
    from there, while one can still be nearer than the second nearest found: the ball shrinks
    with every hit. Distances that are compared are exact integers.
    """
    k, c = len(at.centroids), at.centroids
    upper += at.moved[a]
    if k == 1:
        upper[:], lower[:] = np.sqrt(_squared(v, c[a])), np.inf
        return
    # The largest move among the others: of all, or of all but the one that moved most.
    by_move = np.argsort(-at.moved)
    lower -= np.where(a == by_move[0], at.moved[by_move[1]], at.moved[by_move[0]])
    rows = np.flatnonzero(~(upper * (1 + SLACK) < lower))
    own = _squared(v[rows], c[a[rows]])
    upper[rows] = np.sqrt(own)
    open_ = ~(upper[rows] * (1 + SLACK) < lower[rows])
    rows, own = rows[open_], own[open_]
    other = _squared(v[rows], c[b[rows]])
    first, second = a[rows].copy(), b[rows].copy()
    swap = (other < own) | ((other == own) & (second < first))
    first[swap], second[swap] = second[swap], first[swap]
    d1, d2 = np.where(swap, other, own), np.where(swap, own, other)
    start, known = first.copy(), second.copy()
    radius = np.sqrt(d1)
    apart = at.apart
    for s in np.unique(start):
        left = np.flatnonzero(start == s)
        for j in np.argsort(apart[s], kind="stable"):
            if j == s:
                continue
            left = left[apart[s, j] <= (radius[left] + np.sqrt(d2[left])) * (1 + SLACK)]
            if not len(left):
                break
            new = left[known[left] != j]
            d = _squared(v[rows[new]], c[j])
            best = (d < d1[new]) | ((d == d1[new]) & (j < first[new]))
            won = new[best]
            second[won], d2[won] = first[won], d1[won]
            first[won], d1[won] = j, d[best]
            next_ = ~best & (d < d2[new])
            second[new[next_]], d2[new[next_]] = j, d[next_]
    a[rows], b[rows] = first, second
    upper[rows], lower[rows] = np.sqrt(d1), np.sqrt(d2)


def _advance(state: DataFrame, at: Round, last: bool) -> DataFrame:
    """One assignment of all vectors; the last one also takes every exact distance."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.only()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch["v"].flatten().to_numpy().astype(np.int64).reshape(n, -1)
            a, b, upper, lower = (np.array(batch[c].to_numpy(zero_copy_only=False)) for c in ("a", "b", "upper", "lower"))
            assign(v, a, b, upper, lower, at)
            distance = _squared(v, at.centroids[a]) if last else np.zeros(n, np.int64)
            columns = [batch["id"], batch["v"], a, b, upper, lower, distance]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=names)

    names = state.columns
    return state.mapInArrow(step, state.schema)


def _means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Exact floor of each cluster's mean; an empty cluster keeps its centroid."""
    k, dims = before.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per cluster and task: its count and sums."""
        totals = np.zeros((k, 1 + dims), np.int64)
        for batch in batches:
            a = batch["a"].to_numpy()
            v = batch["v"].flatten().to_numpy().astype(np.int64).reshape(len(a), -1)
            for c in np.unique(a):
                mine = v[a == c]
                totals[c, 0] += len(mine)
                totals[c, 1:] += mine.sum(axis=0)
        some = np.flatnonzero(totals[:, 0])
        yield pa.RecordBatch.from_pydict({"a": pa.array(some, pa.int32()), "sums": pa.array(list(totals[some]), pa.list_(pa.int64()))})

    partials = state.select("a", "v").mapInArrow(partial, "a int, sums array<long>")
    sums = partials.select("a", F.posexplode("sums")).groupBy("a", "pos").agg(F.sum("col").alias("total"))
    totals = np.zeros((k, 1 + dims), np.int64)
    for r in sums.collect():  # k times dims
        totals[r["a"], r["pos"]] = r["total"]
    some = totals[:, 0] > 0
    after = before.copy()
    after[some] = totals[some, 1:] // totals[some, :1]
    return after


def cluster(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    *,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    prefix: str = "3:",
) -> DataFrame:
    """Lloyd's k-means on integer vectors, from ``seeds``: ``rounds`` times assign and average,
    then assign once more. One row per vector of ``whole_vectors``: id, cluster, distance
    (squared), cluster_inertia, inertia, centroid_sha256 (of its final components, joined by
    commas).

    A vector's bounds stay beside it between rounds, in a settled table that replaces the one
    before, so a round reads and writes every vector once and a lost executor costs no earlier
    round. Averages are aggregates of Spark. To the driver come k centroids a round.
    Repeated rows are rows of their own. With fewer than k vectors there are fewer clusters; a
    table without a fit vector gives no rows. An inertia beyond a long is null.
    """
    spark = df.sparkSession
    with settled_apart(spark) as folder:
        vectors = settle(whole_vectors(df, id_column, vector_column, dims=dims, scale=scale))
    centroids = seeds(vectors, k, prefix)
    kind = vectors.schema["id"].dataType.simpleString()
    if not len(centroids):
        nothing = spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        return nothing.withColumnRenamed("id", id_column)
    state = vectors.select(
        "id",
        "v",
        F.lit(0).alias("a"),
        F.lit(min(1, len(centroids) - 1)).alias("b"),
        F.lit(float("inf")).alias("upper"),
        F.lit(0.0).alias("lower"),
        F.lit(0).cast("long").alias("distance"),
    )
    moved = np.zeros(len(centroids))
    for number in range(rounds + 1):
        before = folder
        with settled_apart(spark) as folder:
            state = settle(_advance(state, Round(centroids, moved), number == rounds))
        forget_settled(spark, before)
        if number < rounds:
            after = _means(state, centroids)
            moved = np.sqrt(((after - centroids).astype(float) ** 2).sum(axis=1))
            centroids = after
    marks = [
        (i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)
    ]
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    with settled_apart(spark):
        of_cluster = settle(state.groupBy("a").agg(exact.alias("own")))
    whole = of_cluster.agg(F.sum("own")).first()[0]
    per_cluster = (
        of_cluster.join(spark.createDataFrame(marks, "a int, centroid_sha256 string"), "a")
        .withColumn("cluster_inertia", F.col("own").try_cast("long"))
        .withColumn("inertia", F.lit(whole).cast("decimal(38,0)").try_cast("long"))
    )
    return state.join(F.broadcast(per_cluster), "a").select(  # k rows
        F.col("id").alias(id_column), F.col("a").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
