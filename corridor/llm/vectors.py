"""Vectors as exact integers: shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors that a task works on at a time.
BLOCK_ROWS = 1024


def finite_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the rows whose vector holds finite numbers only; other columns go.

    Null vectors and vectors with a null, NaN or infinite component are left out. A null
    id stays null; repeated rows stay repeated; an empty vector counts as finite.
    """
    v = F.col(vector_col).cast("array<double>")
    broken = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & ~F.coalesce(broken, F.lit(False))
    )


def filled_up(vectors: DataFrame, dims: int) -> DataFrame:
    """The same vectors, shorter ones continued with zeros up to ``dims`` components."""
    missing = F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(dims) - F.size("v")))
    return vectors.select("vec_id", F.concat("v", missing).alias("v"))


def longest(vectors: DataFrame) -> int:
    """The number of components of the longest vector, 0 if there is none."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def quantised(matrix: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` as longs; values beyond ``limit`` either way count as the limit."""
    return np.clip(np.floor(matrix * scale), -limit, limit).astype(np.int64)


def blocks(
    batches: Iterator[pa.RecordBatch], dims: int, rows: int = BLOCK_ROWS
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and the matrix of vectors, at most ``rows`` of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), flat.reshape(part.num_rows, dims)
