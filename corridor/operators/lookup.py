"""Bring per-key values back to the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_by_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``rows`` to ``per_key``, which has one row per ``keys``; null keys match.

    One equi join for every key, whatever its size. The side of the rows is the one
    that is kept, so adaptive execution may split a partition that a hot key makes
    large, and repeats only that key's single row.
    """
    values = [c for c in per_key.columns if c not in keys]
    named = per_key.select(*(F.col(k).alias(f"_key_{k}") for k in keys), *values)
    same = reduce(
        lambda a, b: a & b, (rows[k].eqNullSafe(named[f"_key_{k}"]) for k in keys)
    )
    return rows.join(named, same, "left").select(*rows.columns, *values)
