"""Whitening of vectors from an incremental eigendecomposition.

1. Every task keeps the spectrum (number, mean, eigenvalues, eigenvectors) of the vectors
   it has seen and adds each one as a centred rank-one update, by the roots of the
   secular equation with deflation (``secular``). Equal vectors of a block are one update.
2. Spectra are combined sixteen at a time, level by level, by one update per eigenvector
   and one for the two means: no task or driver holds more than sixteen of them.
3. Rayleigh-Ritz: all vectors are projected on the combined eigenvectors, the small matrix
   of their products is added up over the tasks, and its eigenvectors turn the basis. That
   takes out what rounding left in thousands of updates.

The measured covariance of the whitened vectors then gives ``identity_error``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import ready
from corridor.llm.secular import EPS, Spectrum
from corridor.llm.stored import stored
from corridor.llm.vectors import blocks, filled_up, finite_vectors, longest, quantised

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
#: Spectra combined by one task.
FAN_IN = 16
#: Entries beyond this count as this much, so that sums of a task fit a long.
LIMIT = 1 << 40
SPECTRUM = "part bigint, n bigint, total array<bigint>, mean array<double>, values array<double>, basis binary"
RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


def spectra(vectors: DataFrame, dims: int, scale: int, offset: int) -> DataFrame:
    """One row per task with vectors: exact sums and the spectrum of its vectors, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, total = Spectrum.empty(dims), np.zeros(dims, np.int64)
        for _, matrix in blocks(batches, dims):
            x = quantised(matrix, scale, LIMIT)
            total += (x + offset).sum(axis=0)
            distinct, copies = np.unique(x, axis=0, return_counts=True)
            for vector, n in zip(distinct.astype(float), copies.tolist()):
                spectrum.add(vector, n)
        if spectrum.n:
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": TaskContext.get().partitionId(),
                        "n": spectrum.n,
                        "total": total.tolist(),
                        "mean": spectrum.mean.tolist(),
                        "values": spectrum.values.tolist(),
                        "basis": spectrum.basis.tobytes(),
                    }
                ]
            )

    return stored(vectors.mapInArrow(run, SPECTRUM), "spectra")


def combined(parts: DataFrame, dims: int, fan_in: int = FAN_IN) -> Spectrum:
    """The spectrum of all parts."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        spectrum = Spectrum.empty(dims)
        for r in group.sort_values("part").itertuples():
            basis = np.frombuffer(r.basis).reshape(dims, dims).copy()
            spectrum.merge(Spectrum(r.n, np.array(r.mean), np.array(r.values), basis))
        return pd.DataFrame(
            {
                "part": [group["part"].iloc[0] // fan_in],
                "n": [spectrum.n],
                "mean": [spectrum.mean],
                "values": [spectrum.values],
                "basis": [spectrum.basis.tobytes()],
            }
        )

    level = parts.drop("total")
    last = parts.agg(F.max("part")).first()[0]
    while last > 0:
        level = level.groupBy(F.floor(F.col("part") / fan_in)).applyInPandas(merge, level.schema)
        last //= fan_in
    (r,) = level.collect()
    return Spectrum(
        r["n"], np.array(r["mean"]), np.array(r["values"]), np.frombuffer(bytes(r["basis"])).reshape(dims, dims)
    )


def summed(
    vectors: DataFrame, dims: int, size: int, products: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """``products`` of every block of vectors, ``size`` numbers, added up over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, matrix in blocks(batches, dims):
            total += products(matrix)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

    rows = (
        vectors.mapInArrow(run, "total array<double>")
        .select(F.posexplode("total"))
        .groupBy("pos")
        .agg(F.sum("col").alias("total"))
        .collect()
    )
    out = np.zeros(size)
    for r in rows:
        out[r["pos"]] = r["total"]
    return out


@dataclass
class Centre:
    """Exact number and sums of the vectors; entries are ``floor(scale * c) + offset``."""

    n: int
    sums: list[int]
    scale: int
    offset: int

    @classmethod
    def of(cls, parts: DataFrame, scale: int, offset: int) -> Centre:
        rows = (
            parts.select("n", F.posexplode("total"))
            .groupBy("pos")
            .agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total"))
            .orderBy("pos")
            .collect()
        )
        return cls(rows[0]["n"] if rows else 0, [int(r["total"]) for r in rows], scale, offset)

    def entries(self, matrix: np.ndarray) -> np.ndarray:
        return quantised(matrix, self.scale, LIMIT) + self.offset

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part of the mean leaves exactly, then the rest."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (self.entries(matrix) - whole) - rest

    def deviations(self, matrix: np.ndarray) -> pa.Array:
        """Sums of ``(n * x - S)^2``, exact; null where a long cannot hold one.

        Arithmetic modulo 2^64 is exact for what fits; doubles tell what does not, and
        whole numbers of any size decide next to the border.
        """
        x = self.entries(matrix)
        apart = x.astype(np.uint64) * np.uint64(self.n % 2**64) - np.array(
            [s % 2**64 for s in self.sums], np.uint64
        )
        exact = (apart * apart).sum(axis=1).astype(np.int64)
        size = (self.centred(matrix) ** 2).sum(axis=1) * float(self.n) ** 2 / 2.0**63
        broken = size >= 1
        for row in np.flatnonzero(np.abs(size - 1) < 1e-9):
            value = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[row], self.sums))
            broken[row] = value >= 1 << 63
        return pa.array(exact, mask=broken)


@dataclass
class Whitening:
    """Fitted components, largest variance first."""

    centre: Centre
    directions: np.ndarray  # dims x components, unit columns
    variances: np.ndarray
    explained: np.ndarray

    def apply(self, matrix: np.ndarray) -> np.ndarray:
        return self.centre.centred(matrix) @ self.directions / np.sqrt(self.variances)


def fit(
    vectors: DataFrame, dims: int, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> Whitening | None:
    """Components of all ``vectors`` (vec_id, v of ``dims`` numbers), None for an empty table.

    A component without variance cannot be whitened, so there are at most as many as the
    covariance has values above rounding.
    """
    parts = spectra(vectors, dims, scale, offset)
    centre = Centre.of(parts, scale, offset)
    if not centre.n:
        return None
    basis, _ = np.linalg.qr(combined(parts, dims).basis)

    def products(matrix: np.ndarray) -> np.ndarray:
        y = centre.centred(matrix) @ basis
        return (y.T @ y).ravel()

    small = summed(vectors, dims, dims * dims, products).reshape(dims, dims) / centre.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    some = np.flatnonzero(values > 16 * dims * EPS * max(values[0], 0))[:components]
    trace = max(values.clip(0).sum(), np.finfo(float).tiny)
    return Whitening(centre, basis @ turn[:, some], values[some], values[some] / trace)


def identity_error(vectors: DataFrame, dims: int, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    k, n = len(fitted.variances), fitted.centre.n

    def products(matrix: np.ndarray) -> np.ndarray:
        w = fitted.apply(matrix)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = summed(vectors, dims, k + k * k, products) / n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """Every vector in its first ``components`` whitened coordinates, one row for each.

    Left out are rows whose vector is null or holds a null or non-finite entry. Entry c
    counts as the long ``floor(scale * c) + offset`` (beyond 2^40 as that limit); shorter
    vectors are continued with zeros. All vectors are fitted, repeated rows each time.
    ``deviation`` is the exact sum of ``(n * x - S)^2``, null where a long cannot hold it.
    Components without variance are left out: a table of equal vectors, like an empty
    one, gives no rows. Null ids stay, other columns are not read. Time grows with the
    cube of the vectors' length (about 1.5 ms a vector for 64).
    """
    spark = ready(df.sparkSession)
    vectors = finite_vectors(df, id_col, vector_col)
    dims = max(1, longest(vectors))
    vectors = filled_up(vectors, dims)
    fitted = fit(vectors, dims, components, scale, offset)
    if fitted is None or not len(fitted.variances):
        return spark.createDataFrame([], RESULT)
    k, n = len(fitted.variances), fitted.centre.n
    error = identity_error(vectors, dims, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, matrix in blocks(batches, dims):
            rows = len(matrix)
            every = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(every),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    fitted.centre.deviations(matrix).take(every),
                    pa.array(fitted.apply(matrix).ravel()),
                    pa.array(np.tile(fitted.explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, RESULT)
