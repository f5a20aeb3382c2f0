"""Exact top-k by inner product with a vector-approximation file.

Each component is replaced by the number of its cell, so a vector becomes one byte per
component; a cell knows the smallest and largest value that fell into it. Three steps
for each block of queries:

1. Scan the cells alone. Two matrix products give a lower bound of every score; the kth
   largest lower bound of a query, over all rows, is a floor for its kth score.
2. Scan the cells again for upper bounds. Exact vectors are read only for rows whose
   upper bound reaches the floor, in the order of those bounds, until no remaining bound
   can enter the task's k best.
3. Merge the few rows that the tasks return for each query.

Nothing is approximate: the cells decide what is read, never what is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor.llm.batches import ready
from corridor.llm.stored import new_path, stored
from corridor.llm.vectors import BLOCK_ROWS, blocks, filled_up, finite_vectors, longest, quantised

K = 5
SCALE = 256
QUERY_EVERY = 50
#: Cells per component; their borders are quantiles of a sample of this many vectors,
#: the values they hold are those of all vectors.
CELLS = 64
SAMPLE_ROWS = 4096
#: Queries that are compared with all vectors in one scan.
QUERY_BLOCK = 2048
#: Exact vectors read at a time.
READ_ROWS = 32
#: Stands for a null id while ids are compared: it is the last in any order.
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min
FOUND = "query int, query_id bigint, vec_id bigint, score bigint"


def limit(dims: int) -> int:
    """The largest component for which every inner product fits a long."""
    return 1 << ((62 - max(1, dims - 1).bit_length()) // 2)


@dataclass
class Cells:
    """Borders between the cells of each component, and what the cells hold."""

    borders: np.ndarray  # dims x (cells - 1), ascending
    low: np.ndarray | None = None  # dims x cells
    high: np.ndarray | None = None

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """The cell of every component."""
        out = np.empty(x.shape, np.uint8)
        for d, borders in enumerate(self.borders):
            out[:, d] = np.searchsorted(borders, x[:, d], side="right")
        return out

    def edges(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and the largest vector that may lie in the given cells."""
        d = np.arange(cells.shape[1])
        return self.low[d, cells].astype(np.float64), self.high[d, cells].astype(np.float64)


@dataclass
class Queries:
    """A block of query vectors, with what bounds need."""

    ids: np.ndarray
    x: np.ndarray

    def __post_init__(self) -> None:
        self.order = np.argsort(self.ids, kind="stable")
        self.sorted_ids = self.ids[self.order]
        self.up = np.maximum(self.x, 0).astype(np.float64).T.copy()
        self.down = np.minimum(self.x, 0).astype(np.float64).T.copy()

    def slack(self, cells: Cells) -> np.ndarray:
        """What rounding may take from a bound; 0 while products are exact in doubles."""
        reach = np.maximum(abs(cells.low), abs(cells.high)).max(axis=1).astype(np.float64)
        most = abs(self.x).astype(np.float64) @ reach
        return np.where(most < 2.0**52, 0.0, most * 2.0**-44)

    def own(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, query) with the same id."""
        first = np.searchsorted(self.sorted_ids, ids, side="left")
        last = np.searchsorted(self.sorted_ids, ids, side="right")
        named = np.flatnonzero(last > first)
        rows = np.repeat(named, (last - first)[named])
        places = [p for i in named for p in range(first[i], last[i])]
        return rows, self.order[np.array(places, np.int64)]


def fit_cells(vectors: DataFrame, dims: int, cells: int, sample_rows: int, scale: int) -> Cells:
    """Borders at the quantiles of the vectors with the smallest hashes."""
    rows = (
        vectors.select(F.xxhash64("vec_id", "v").alias("h"), "v").orderBy("h", "v").limit(sample_rows).collect()
    )
    x = quantised(np.array([r["v"] for r in rows], float).reshape(-1, dims), scale, limit(dims))
    at = (np.arange(1, cells) * len(x)) // cells
    return Cells(np.sort(x, axis=0)[at].T.copy())


def write_file(vectors: DataFrame, cells: Cells, dims: int, scale: int) -> DataFrame:
    """The stored file: ``(vec_id, cells, exact)``, where a scan may read the cells alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, matrix in blocks(batches, dims):
            x = quantised(matrix, scale, limit(dims))
            numbers = cells.numbers(x)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([n.tobytes() for n in numbers], pa.binary()),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                ],
                ["vec_id", "cells", "exact"],
            )

    return stored(vectors.mapInArrow(run, "vec_id bigint, cells binary, exact binary"), "va_file")


def with_contents(cells: Cells, file: DataFrame, dims: int) -> Cells:
    """The cells with the smallest and largest value of all vectors in each."""
    n = cells.borders.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims * n, NO_ID), np.full(dims * n, LOWEST)
        for part in parts(batches):
            at = (matrix_of(part.column(0), dims, np.uint8) + np.arange(dims) * n).ravel()
            x = matrix_of(part.column(1), dims, np.int64).ravel()
            np.minimum.at(low, at, x)
            np.maximum.at(high, at, x)
        some = np.flatnonzero(low <= high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(low[some]), pa.array(high[some])],
            ["cell", "low", "high"],
        )

    rows = (
        file.select("cells", "exact")
        .mapInArrow(run, "cell int, low bigint, high bigint")
        .groupBy("cell")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .collect()
    )
    low, high = np.zeros(dims * n, np.int64), np.zeros(dims * n, np.int64)
    for r in rows:
        low[r["cell"]], high[r["cell"]] = r["low"], r["high"]
    return Cells(cells.borders, low.reshape(dims, n), high.reshape(dims, n))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def matrix_of(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    """A column of equally long byte strings as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims)


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def floors(file: DataFrame, cells: Cells, queries: Queries, k: int) -> np.ndarray:
    """For every query the kth largest lower bound of all rows; minus infinity if there are fewer."""
    dims, n, slack = queries.x.shape[1], len(queries.ids), queries.slack(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((k, n), -np.inf)
        for part in parts(batches):
            low, high = cells.edges(matrix_of(part.column(1), dims, np.uint8))
            bound = low @ queries.up + high @ queries.down
            bound[queries.own(ids_of(part.column(0)))] = -np.inf
            best = np.partition(np.vstack([best, bound]), -k, axis=0)[-k:]
        query, place = np.nonzero(best.T > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(best[place, query] - slack[query])],
            ["query", "bound"],
        )

    best_first = Window.partitionBy("query").orderBy(F.col("bound").desc())
    rows = (
        file.select("vec_id", "cells")
        .mapInArrow(run, "query int, bound double")
        .withColumn("place", F.row_number().over(best_first))
        .where(F.col("place") == k)
        .collect()
    )
    floor = np.full(n, -np.inf)
    for r in rows:
        floor[r["query"]] = r["bound"]
    return floor


class Best:
    """The k best (score, id) of one query in a task, best first."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def full(self) -> bool:
        return len(self.scores) == self.k

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, ~scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]

    def certain(self, bound: float, smallest_id: int) -> bool:
        """Whether nothing with this upper bound and no smaller id can still enter."""
        if not self.full():
            return False
        last = self.scores[-1]
        return bound < last or (bound == last and smallest_id >= self.ids[-1])


def read_exact(
    best: Best, query: np.ndarray, rows: np.ndarray, bound: np.ndarray, ids: np.ndarray, exact: pa.Array
) -> None:
    """Score ``rows`` in the order of their upper bounds until the k best are certain."""
    rows = rows[np.lexsort((ids[rows], -bound[rows]))]
    for at in range(0, len(rows), READ_ROWS):
        some = rows[at : at + READ_ROWS]
        if best.certain(bound[some[0]], ids[some[0]]):
            return
        best.add(matrix_of(exact.take(pa.array(some)), len(query), np.int64) @ query, ids[some])


def best_rows(file: DataFrame, cells: Cells, queries: Queries, floor: np.ndarray, k: int) -> DataFrame:
    """``(query, query_id, vec_id, score)``: each task's k best that reach their query's floor."""
    dims, n, slack = queries.x.shape[1], len(queries.ids), queries.slack(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in range(n)]
        least = floor.copy()
        for part in parts(batches):
            ids = ids_of(part.column(0))
            low, high = cells.edges(matrix_of(part.column(1), dims, np.uint8))
            bound = high @ queries.up + low @ queries.down + slack
            bound[queries.own(ids)] = -np.inf
            # An own row has no bound; any other may have to be read.
            reach = (bound >= least) & (bound > -np.inf)
            for j in np.flatnonzero(reach.any(axis=0)):
                read_exact(best[j], queries.x[j], np.flatnonzero(reach[:, j]), bound[:, j], ids, part.column(2))
                if best[j].full():
                    least[j] = max(least[j], best[j].scores[-1])
        query = np.repeat(np.arange(n), [len(b.scores) for b in best])
        scores = np.concatenate([b.scores for b in best])
        ids = np.concatenate([b.ids for b in best])
        some = scores >= floor[query]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query[some], pa.int32()),
                pa.array(queries.ids[query[some]]),
                pa.array(ids[some], mask=ids[some] == NO_ID),
                pa.array(scores[some]),
            ],
            ["query", "query_id", "vec_id", "score"],
        )

    return file.mapInArrow(run, FOUND)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    cells: int = CELLS,
    sample_rows: int = SAMPLE_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for every query.

    Returns ``(query_id, rank, vec_id, score)``; all rows if there are fewer than ``k``.
    Component x counts as ``floor(scale * x)``, beyond ``limit(dims)`` (2^28 for 64
    components) as that limit, so that scores fit a long. Rows whose vector is null or
    holds a null or non-finite component take no part on either side; shorter vectors are
    continued with zeros. A query's own row is what has its id. Ties go to the smaller id,
    a null id is last (the largest long is not told from it) and is never a query.
    Repeated rows of ``vectors`` are candidates of their own; equal queries are answered
    once, different vectors under one id each get their own ranks. Other columns are not
    read. An empty table on either side gives an empty result.

    The queries are worked on in blocks of about ``query_block``, by the hash of id and
    vector: a block is all that the driver and the tasks hold, and each block scans all
    rows. ``cells`` is at most 256.
    """
    spark = ready(vectors.sparkSession)
    rows = finite_vectors(vectors, id_col, vector_col)
    asked = finite_vectors(queries, id_col, vector_col).where(F.col("vec_id").isNotNull())
    dims = max(1, longest(rows), longest(asked))
    rows = filled_up(rows, dims)
    asked = stored(filled_up(asked, dims).distinct(), "queries")
    n_blocks = -(-asked.count() // query_block)
    path = new_path(spark, "found")
    spark.createDataFrame([], FOUND + ", block int").write.parquet(path)
    if n_blocks and not rows.isEmpty():
        cells_of = fit_cells(rows, dims, cells, sample_rows, scale)
        file = write_file(rows, cells_of, dims, scale)
        cells_of = with_contents(cells_of, file, dims)
        of_block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks))
        for block in range(n_blocks):
            some = asked.where(of_block == block).orderBy("vec_id", "v").collect()
            if some:
                x = quantised(np.array([r["v"] for r in some], float), scale, limit(dims))
                batch = Queries(np.array([r["vec_id"] for r in some], np.int64), x)
                best = best_rows(file, cells_of, batch, floors(file, cells_of, batch, k), k)
                best.withColumn("block", F.lit(block)).write.mode("append").parquet(path)
    found = spark.read.parquet(path)
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def oracle(k: int = K, scale: int = SCALE, every: int = QUERY_EVERY) -> str:
    """The same by comparing every query with every row, as DuckDB SQL."""
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
q AS MATERIALIZED (
    SELECT row_number() OVER () AS number, * FROM (SELECT DISTINCT vec_id, x FROM v WHERE vec_id % {every} = 0)),
scores AS (
    SELECT q.number, q.vec_id AS query_id, v.vec_id,
           list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * v.x[i]))::BIGINT AS score
    FROM q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY number ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER best <= {k}"""
