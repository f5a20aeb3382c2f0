"""Block arithmetic on a corridor that closes on itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ring(idx: Column, k: int, n_blocks: int) -> Column:
    """Index of the block ``k`` further on."""
    return F.pmod(idx + k, F.lit(n_blocks))


def block_name(idx: Column) -> Column:
    """Block id of a zero-based index."""
    return F.format_string("B_%03d", idx + 1)


def block_dim(spark: SparkSession, n_blocks: int) -> DataFrame:
    """One row per block of the corridor."""
    idx = F.col("id").cast("int")
    return spark.range(n_blocks).select(idx.alias("block_idx"), block_name(idx).alias("block_id"))
