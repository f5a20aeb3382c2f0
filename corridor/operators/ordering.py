"""Row numbers and previous values per key that stay balanced under a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seconds of event time in one bucket.
BUCKET_SECONDS = 3600


def time_bucket(name: str, seconds: int = BUCKET_SECONDS) -> Column:
    """Number of the time range a timestamp lies in; null for null."""
    return F.floor(F.unix_micros(F.col(name)) / F.lit(seconds * 1_000_000))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``row_no`` (from 1) and ``prev_<c>`` per key, in ``order``.

    ``keys`` plus ``order`` must be unique. ``bucket`` never falls along ``order``; by
    default it is the hour of the first column. Rows are numbered inside each bucket,
    so the rows of one key are spread over as many groups as it has buckets; what came
    before is added from one small row per bucket, the number and the carried values of
    its last row. Null keys are one key.

    The rows are shuffled once. Key and bucket are one struct, which is never null, so the
    join uses the partitions of the window. A row travels as an array of one struct: that
    keeps the optimizer from cutting it down to other columns for the numbered rows than
    for the last rows, and both read the same shuffle. Give only columns that are needed.
    """
    placed = df.select(
        F.struct(*keys, (time_bucket(order[0]) if bucket is None else bucket).alias("_bucket")).alias("_group"),
        F.array(F.struct(*df.columns)).alias("_rows"),
        F.struct(F.lit(1).alias("_one"), *carry).alias("_carry"),
    )
    inside = Window.partitionBy("_group").orderBy(*(F.col("_rows")[0][c] for c in order))
    numbered = placed.withColumns(
        {"_no": F.row_number().over(inside), "_prev": F.lag("_carry").over(inside)}
    )
    per_bucket = (
        placed.withColumns({"_n": F.row_number().over(inside), "_next": F.lead("_rows").over(inside)})
        .where(F.col("_next").isNull())
        .select(F.col("_group").alias("_of"), "_n", "_carry")
    )
    along = Window.partitionBy(*(F.col("_of")[k] for k in keys)).orderBy(F.col("_of")["_bucket"])
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select(
        "_of",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.lag("_carry").over(along).alias("_carried"),
    )
    first = F.col("_no") == 1
    return (
        numbered.join(before, F.col("_group") == F.col("_of"))
        .select("_no", "_before", "_prev", "_carried", F.inline("_rows"))
        .select(
            *df.columns,
            (F.col("_no") + F.col("_before")).alias("row_no"),
            *(
                F.when(first, F.col("_carried")[c]).otherwise(F.col("_prev")[c]).alias(f"prev_{c}")
                for c in carry
            ),
        )
    )
