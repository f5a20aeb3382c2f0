"""What a dashboard loads at every refresh, over the newest files of a Gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corridor.config import DEFAULT, CorridorConfig
from corridor.operators.serving import latest_per_train, marey_series
from corridor.schema import GOLD
from corridor.sources.tables import read_with_fallback

# How many of the newest files count as state and as history.
STATE_FILES = 8
HISTORY_FILES = 20


def load_state(
    spark: SparkSession, gold_path: str, sample_path: str, cfg: CorridorConfig = DEFAULT
) -> tuple[DataFrame, bool]:
    """Latest row per train, and whether it comes from the sample."""
    rows, is_sample = read_with_fallback(spark, gold_path, sample_path, GOLD, STATE_FILES)
    return latest_per_train(rows, cfg), is_sample


def load_history(
    spark: SparkSession, gold_path: str, sample_path: str, cfg: CorridorConfig = DEFAULT
) -> DataFrame:
    """Time-distance series of the newest files."""
    rows, _ = read_with_fallback(spark, gold_path, sample_path, GOLD, HISTORY_FILES)
    return marey_series(rows, cfg)
