"""Centroid clustering by a tournament of bisectors, in exact integers.

For centroids a < b, a vector x is at least as near to a as to b exactly when
``x . 2(b - a) <= |b|^2 - |a|^2``. Normals and thresholds of all pairs are computed once
a round; a vector then meets the centroids one after another, the loser of each sign
test is out, and after k - 1 tests the champion is its nearest centroid. A zero favours
the smaller number. Only the champion's distance is computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import ready
from corridor.llm.stored import stored
from corridor.llm.vectors import blocks, finite_vectors, quantised

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1


def limit(dims: int) -> int:
    """The largest component for which every squared distance fits a long."""
    return 1 << ((62 - max(1, dims - 1).bit_length()) // 2 - 1)


@dataclass
class Bisectors:
    """Normals and thresholds for all pairs of centroids."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        squares = (centroids * centroids).sum(axis=1)
        return cls(
            centroids,
            2 * (centroids[None, :, :] - centroids[:, None, :]),
            squares[None, :] - squares[:, None],
        )

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; ties go to the smaller one."""
        champion = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", x, self.normals[champion, rival])
            champion[side > self.thresholds[champion, rival]] = rival
        return champion

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Squared distance to the given centroid of each row."""
        apart = x - self.centroids[cluster]
        return np.einsum("nd,nd->n", apart, apart)


def first_centroids(vectors: DataFrame, k: int, scale: int, dims: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes; equal hashes by vector, null ids last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (
        vectors.select(order.alias("h"), "v")
        .orderBy(F.col("h").asc_nulls_last(), "v")
        .limit(k)
        .collect()
    )
    return quantised(np.array([r["v"] for r in rows], float).reshape(-1, dims), scale, limit(dims))


def moved(vectors: DataFrame, pairs: Bisectors, scale: int) -> np.ndarray:
    """The centroids after one round; a centroid without vectors stays.

    Every task returns one row per cluster (its number of vectors and their sums), and
    those rows are added up per cluster and component: k * dims small rows come back.
    """
    k, dims = pairs.centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, matrix in blocks(batches, dims):
            x = quantised(matrix, scale, limit(dims))
            cluster = pairs.nearest(x)
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    rows = (
        vectors.mapInArrow(sums, "cluster int, n bigint, total array<bigint>")
        .select("cluster", "n", F.posexplode("total"))
        .groupBy("cluster", "pos")
        .agg(F.sum("n").alias("n"), F.sum("col").alias("total"))
        .collect()
    )
    centroids = pairs.centroids.copy()
    for r in rows:
        centroids[r["cluster"], r["pos"]] = r["total"] // r["n"]
    return centroids


def assigned(vectors: DataFrame, pairs: Bisectors, scale: int) -> DataFrame:
    """``(vec_id, cluster, distance)`` for every vector."""
    dims = pairs.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, matrix in blocks(batches, dims):
            x = quantised(matrix, scale, limit(dims))
            cluster = pairs.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(pairs.distances(x, cluster))],
                ["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Assign every vector to one of ``k`` centroids after ``rounds`` rounds of moving them.

    Kept are vectors with exactly ``dims`` components, none null or non-finite; component
    x counts as ``floor(scale * x)``, beyond ``limit(dims)`` (2^27 for 64) as that limit, so
    that distances fit a long. The first centroids are the vectors whose ids' hashes are
    smallest; equal hashes (repeated ids) are ordered by vector, null ids come last. With
    fewer than ``k`` vectors there are as many centroids. Repeated rows are rows of their
    own, a null id stays in the result, columns besides the two named ones are not read,
    an empty table gives an empty result. ``cluster_inertia`` and ``inertia`` are null
    where a long cannot hold the sum. ``k`` bounds what the driver holds: k * dims sums a
    round, and k * k normals; it is meant for up to a few hundred.
    """
    ready(df.sparkSession)
    vectors = finite_vectors(df, id_col, vector_col).where(F.size("v") == dims)
    centroids = first_centroids(vectors, k, scale, dims, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, Bisectors.of(centroids), scale)
    if not len(centroids):
        # No vector is left: any centroid serves an empty result.
        centroids = np.zeros((1, dims), np.int64)
    rows = stored(assigned(vectors, Bisectors.of(centroids), scale), "assigned")
    per_cluster = rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    )
    totals = {r["cluster"]: int(r["total"]) for r in per_cluster.collect()}

    def whole(value: int):
        return F.lit(value if value < 1 << 63 else None).cast("bigint")

    of_cluster = [whole(totals.get(c, 0)) for c in range(len(centroids))]
    digests = [
        F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centroids
    ]
    number = F.col("cluster") + 1
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*of_cluster), number).alias("cluster_inertia"),
        whole(sum(totals.values())).alias("inertia"),
        F.element_at(F.array(*digests), number).alias("centroid_sha256"),
    )


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same by plain distances to all centroids, as DuckDB SQL."""
    apart = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
    SELECT r, vec_id, v.x, c.number, {apart} AS distance
    FROM kept v, c{i} c
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c.number) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (
    SELECT number, pos, sum(x[pos])::BIGINT AS total, count(*)::BIGINT AS n
    FROM a{i}, range(1, {dims + 1}) p(pos) GROUP BY number, pos),
m{i} AS (
    SELECT number, list((total - (((total % n) + n) % n)) // n ORDER BY pos) AS x FROM s{i} GROUP BY number),
c{i + 1} AS MATERIALIZED (
    SELECT c.number, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.number = c.number)"""
            )
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {dims}
      AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS number, x
    FROM kept QUALIFY number < {k}),
{",\n".join(steps)}
SELECT vec_id, number::INTEGER AS cluster, distance,
       (sum(distance) OVER (PARTITION BY number))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       (SELECT sha256(array_to_string(c.x, ',')) FROM c{rounds} c WHERE c.number = a{rounds}.number) AS centroid_sha256
FROM a{rounds}"""
