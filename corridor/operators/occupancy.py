"""Latest state per train in sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig

# Occupancy column -> event column.
STATE = {
    "block_id": "block_id",
    "block_idx": "block_idx",
    "signal_aspect": "signal_aspect_ahead",
    "speed_mph": "current_speed_mph",
    "schedule_adherence_sec": "schedule_adherence_sec",
    "track_grade_pct": "track_grade_pct",
}


def occupancy(silver: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """One row per window and train: the train's newest event in that window.

    "Newest" is the largest ``(event_time, event_id)``, so the result does not
    depend on arrival order, and the state columns all come from one event.
    Taking the maximum is associative: every task sends at most one row per
    window and train into the shuffle, however many rows a single train has.

    A stream keeps one stateful aggregate. In batch the events are first reduced
    to one row per slide-long pane, so the copies for overlapping windows are
    made from the reduced rows and not from all events.
    """
    return state_columns(latest_states(silver, cfg), cfg)


def latest_states(silver: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """``(window_start, window_end, *keys, state)``, the state with its time and event id."""
    newest = F.struct(
        "event_time", "event_id", *(F.col(src).alias(out) for out, src in STATE.items())
    )
    if silver.isStreaming or cfg.window_sec % cfg.slide_sec:
        latest = _by_window(silver, newest, cfg)
    else:
        latest = _by_pane(silver, newest, cfg)
    return latest.select("window_start", "window_end", *cfg.keys, "state")


def merged_states(states: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """One row per window and train from the states of several sets of events."""
    return states.groupBy("window_start", "window_end", *cfg.keys).agg(F.max("state").alias("state"))


def state_columns(states: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """The columns of the occupancy table."""
    return states.select(
        "window_start",
        "window_end",
        *cfg.keys,
        *(F.col(f"state.{c}").alias(c) for c in STATE),
    )


def _by_window(silver: DataFrame, newest: Column, cfg: CorridorConfig) -> DataFrame:
    span = F.window("event_time", f"{cfg.window_sec} seconds", f"{cfg.slide_sec} seconds")
    return (
        silver.groupBy(span.alias("span"), *cfg.keys)
        .agg(F.max(newest).alias("state"))
        .select("*", F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"))
    )


def _by_pane(silver: DataFrame, newest: Column, cfg: CorridorConfig) -> DataFrame:
    second = F.unix_seconds("event_time")
    pane = (second - F.pmod(second, F.lit(cfg.slide_sec))).alias("pane")
    panes = silver.groupBy(pane, *cfg.keys).agg(F.max(newest).alias("state"))
    back = F.array(*(F.lit(s) for s in range(0, cfg.window_sec, cfg.slide_sec)))
    start = F.col("start_sec")
    return (
        panes.select("*", F.explode(back).alias("back"))
        .groupBy((F.col("pane") - F.col("back")).alias("start_sec"), *cfg.keys)
        .agg(F.max("state").alias("state"))
        .withColumns(
            {
                "window_start": F.timestamp_seconds(start),
                "window_end": F.timestamp_seconds(start + cfg.window_sec),
            }
        )
    )
