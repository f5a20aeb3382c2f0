"""Helpers for functions that work on Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest

from corridor.session import prepare

#: Text a batch may hold, so that a run of long documents stays within a worker's memory.
BATCH_BYTES = 8 << 20
#: Distinct words a worker remembers before it starts anew.
MEMO_WORDS = 300_000


def ready(spark: SparkSession) -> SparkSession:
    """The session with bounded batches for functions on Arrow data."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def slices(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of them."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxh3_64_digest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=">u8").astype(np.uint64)


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` consecutive word hashes; order counts."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _ODD + h[i : i + n]
    return mixed(out)
