"""Small tables a dashboard shows, computed from the whole Gold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig
from corridor.functions import display
from corridor.functions.ring import block_dim

# The block dimension and the state per block have n_blocks rows; they are
# broadcast up to this many and joined by shuffle beyond.
BROADCAST_BLOCKS = 100_000

# Columns a table may lack, and what the serving tables show then.
COLUMN_DEFAULTS = {
    "schedule_adherence_sec": 0.0,
    "signal_aspect": "clear",
    "delay_severity": "nominal",
    "advisory_speed_mph": 79.0,
    "shockwave_delay_sec": 0.0,
    "speed_mph": 0.0,
    "block_id": "?",
}


def with_defaults(df: DataFrame, defaults: dict = COLUMN_DEFAULTS) -> DataFrame:
    """Add absent columns with their default; null values in present columns stay."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def latest_per_train(
    gold: DataFrame, cfg: CorridorConfig = DEFAULT, time: str = "window_start"
) -> DataFrame:
    """Per train and column the last value that is not null.

    Columns are decided one by one, so a row can combine several windows. A table
    without the time column is returned unchanged.
    """
    if time not in gold.columns:
        return gold
    rest = [c for c in gold.columns if c not in cfg.keys]

    def last_known(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c)

    return gold.groupBy(*cfg.keys).agg(*(last_known(c) for c in rest))


def _per_block(latest: DataFrame, columns: Sequence[str], cfg: CorridorConfig) -> DataFrame:
    """Every block of the corridor with the state of the train on it, if any.

    When several trains report one block, the last train id is shown.
    """
    blocks = block_dim(latest.sparkSession, cfg.n_blocks)
    sized = F.broadcast if cfg.n_blocks <= BROADCAST_BLOCKS else (lambda df: df)
    state = F.struct("train_id", *(c for c in columns if c != "train_id"))
    shown = (
        with_defaults(latest)
        .join(sized(blocks.select("block_id")), "block_id", "left_semi")
        .groupBy("block_id")
        .agg(F.max_by(state, "train_id").alias("state"))
    )
    return blocks.join(sized(shown), "block_id", "left")


def track_map(latest: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """One row per block: its train, or CLEAR."""
    occupied = F.col("state").isNotNull()
    signal = F.col("state.signal_aspect")
    return _per_block(latest, ["signal_aspect", "speed_mph"], cfg).select(
        "block_idx",
        "block_id",
        F.col("state.train_id").alias("train_id"),
        F.concat(display.whole_number(F.col("state.speed_mph")), F.lit(" mph")).alias("speed"),
        F.when(occupied, display.code_lookup(signal, display.ASPECT_LABEL, "CLR"))
        .otherwise("CLEAR")
        .alias("label"),
        F.when(
            occupied, display.code_lookup(signal, display.ASPECT_COLOUR, display.DARK_GREEN)
        )
        .otherwise(display.DARK_GREEN)
        .alias("colour"),
    )


def rl_overlay(
    latest: DataFrame,
    advisory_col: str = "advisory_speed_mph",
    cfg: CorridorConfig = DEFAULT,
    tolerance_mph: float = 5.0,
) -> DataFrame:
    """One row per block: does the advice differ from the speed its aspect allows?"""
    signal, advised = F.col("state.signal_aspect"), F.col(f"state.{advisory_col}")
    occupied = F.col("state").isNotNull()
    rule_speed = display.code_lookup(signal, display.RULE_SPEED_MPH, 79.0)
    differs = F.coalesce(F.abs(advised - rule_speed) > tolerance_mph, F.lit(False))
    colour = F.when(differs, display.PURPLE).otherwise(
        display.code_lookup(signal, display.ASPECT_COLOUR, display.DARK_GREEN)
    )
    return _per_block(latest, ["signal_aspect", advisory_col], cfg).select(
        "block_idx",
        "block_id",
        F.col("state.train_id").alias("train_id"),
        F.concat(display.whole_number(advised), F.lit(" mph")).alias("advisory"),
        F.when(occupied, rule_speed).alias("rule_speed_mph"),
        F.when(occupied, differs).alias("differs"),
        F.when(occupied, F.when(differs, "RL").otherwise("STD")).alias("source"),
        F.when(occupied, colour).otherwise(display.DARK_GREEN).alias("colour"),
    )


def advisory_feed(latest: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """One row of display texts per train, in train order."""
    adherence = F.col("schedule_adherence_sec")
    signal, severity = F.col("signal_aspect"), F.lower("delay_severity")

    def unit(c: str, suffix: str) -> Column:
        return F.concat(display.whole_number(F.col(c)), F.lit(suffix))

    return (
        with_defaults(latest)
        .select(
            *cfg.keys,
            "block_id",
            unit("speed_mph", " mph").alias("speed"),
            F.upper(signal).alias("signal"),
            display.code_lookup(signal, display.ASPECT_ICON, "⚪").alias("signal_icon"),
            unit("advisory_speed_mph", " mph").alias("advisory"),
            unit("shockwave_delay_sec", "s").alias("shockwave"),
            display.adherence_label(adherence).alias("adherence"),
            F.when(adherence >= display.LATE_BELOW_SEC, "green")
            .otherwise("red")
            .alias("adherence_colour"),
            F.upper(severity).alias("severity"),
            display.code_lookup(severity, display.SEVERITY_COLOUR, display.GREY).alias(
                "severity_colour"
            ),
        )
        .orderBy(*cfg.keys)
    )


def corridor_summary(latest: DataFrame) -> DataFrame:
    """One row of corridor figures; a figure whose column is absent is 0."""

    def mean(c: str) -> Column:
        return F.avg(c) if c in latest.columns else F.lit(0.0)

    critical = (
        F.count_if(F.col("delay_severity") == "critical")
        if "delay_severity" in latest.columns
        else F.lit(0).cast("bigint")
    )
    return latest.agg(
        mean("schedule_adherence_sec").alias("avg_adherence_sec"),
        mean("speed_mph").alias("avg_speed_mph"),
        critical.alias("critical_trains"),
        mean("advisory_speed_mph").alias("avg_advisory_mph"),
        F.count("*").alias("trains"),
    )


def marey_series(gold: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Time-distance points of every train in time order, with marker and colour."""
    severity = F.lower("delay_severity") if "delay_severity" in gold.columns else F.lit(None)
    optional = ["speed_mph", "schedule_adherence_sec", "delay_severity"]
    return gold.select(
        *cfg.keys,
        F.col("window_start").cast("timestamp").alias("window_start"),
        "block_idx",
        *(c for c in optional if c in gold.columns),
        display.code_lookup(severity.cast("string"), display.SEVERITY_MARKER, "circle").alias(
            "marker"
        ),
        display.code_lookup(F.col("train_id"), display.TRAIN_COLOUR, display.GREY).alias("colour"),
    ).orderBy(*cfg.keys, "window_start")
