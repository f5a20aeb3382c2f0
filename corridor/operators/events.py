"""From keyed JSON rows to validated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig
from corridor.schema import TRAIN_EVENT


def parse_events(raw: DataFrame) -> DataFrame:
    """Decode the JSON in ``value``. Malformed input becomes null fields, not an error.

    ``inline`` of the one parsed struct keeps later filters above the parser; with
    ``select("event.*")`` they are pushed below it and every filter parses again.
    """
    event = F.from_json(F.col("value").cast("string"), TRAIN_EVENT)
    return raw.select(F.inline(F.array(event)))


def with_event_time(events: DataFrame) -> DataFrame:
    """Add ``event_time``; text that is no timestamp gives null, also in ANSI mode."""
    return events.withColumn("event_time", F.try_to_timestamp(F.col("timestamp_utc")))


def validate_events(events: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Keep events with complete keys and values inside the corridor's limits.

    A null in a checked column drops the row; a null adherence does not.
    """
    stamped = with_event_time(events).withWatermark("event_time", f"{cfg.watermark_sec} seconds")
    for rule in validity(cfg):
        stamped = stamped.where(rule)
    return stamped


def validity(cfg: CorridorConfig = DEFAULT) -> list[Column]:
    """What holds for a valid event that has its ``event_time``."""
    known = [F.col(c).isNotNull() for c in (*cfg.keys, "block_id", "event_time")]
    inside = [
        F.col("signal_aspect_ahead").isin(*cfg.aspects),
        F.col("current_speed_mph").between(0.0, float(cfg.max_speed_mph)),
        F.col("block_idx").between(0, cfg.n_blocks - 1),
    ]
    return known + inside


def explode_blocks_ahead(events: DataFrame) -> DataFrame:
    """One row per occupied block an event reports ahead of its train."""
    return events.select(
        "event_id", "train_id", "event_time", F.inline("blocks_ahead_occupied")
    ).withColumnRenamed("block_id", "ahead_block_id")
