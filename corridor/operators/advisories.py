"""Delay and advice columns on top of occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig
from corridor.functions import delays


def with_advisories(occupancy: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add delay, advised speed and severity: stateless, so it also runs on a stream."""
    signal, speed = F.col("signal_aspect"), F.col("speed_mph")
    lateness = delays.base_lateness(F.col("schedule_adherence_sec"))
    slowness = delays.speed_factor(speed, cfg.max_speed_mph)
    return occupancy.withColumns(
        {
            "shockwave_delay_sec": delays.shockwave_delay(signal, lateness, slowness),
            "advisory_speed_mph": delays.advisory_speed(signal, speed, cfg.max_speed_mph),
        }
    ).withColumn("delay_severity", delays.delay_severity(F.col("shockwave_delay_sec")))


def with_blocks_count(gold: DataFrame) -> DataFrame:
    """Occupied blocks ahead as far as the aspect tells: 1 when restricted, else 0."""
    restricted = F.col("signal_aspect").isin("stop", "approach")
    return gold.withColumn("blocks_count", F.when(restricted, 1).otherwise(0))


def sample_columns(df: DataFrame, cols: list[str], n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in ``order``, reduced to ``cols``."""
    return df.orderBy(*order).limit(n).select(*cols)
