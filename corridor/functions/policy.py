"""Observation features, policies and action lookup as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corridor.config import DEFAULT, SPEED_TARGETS_MPH, CorridorConfig
from corridor.functions.display import normalise_code

# Positions in the observation array, and the scales its values are divided by.
OBSERVATION = (
    "speed_norm",
    "is_stop",
    "is_approach",
    "is_clear",
    "ahead_norm",
    "adherence_norm",
    "grade_norm",
    "progress_norm",
)
ADHERENCE_SCALE_SEC = 300.0
GRADE_SCALE_PCT = 3.0
MAX_AHEAD = 2
STOP_ACTION = 0
APPROACH_ACTION = 1
FREE_ACTION = 4


def known(x: Column) -> Column:
    """Null and NaN as 0."""
    return F.nanvl(F.coalesce(x.cast("double"), F.lit(0.0)), F.lit(0.0))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def observation(
    speed: Column,
    signal: Column,
    blocks_count: Column,
    adherence: Column,
    grade: Column,
    block_idx: Column,
    cfg: CorridorConfig = DEFAULT,
) -> Column:
    """The eight features of one train as an array of doubles.

    An aspect outside the known ones gives three zeros.
    """
    aspect = normalise_code(signal, "clear")

    def one_hot(name: str) -> Column:
        return F.when(aspect == name, 1.0).otherwise(0.0)

    return F.array(
        known(speed) / F.lit(float(cfg.max_speed_mph)),
        one_hot("stop"),
        one_hot("approach"),
        one_hot("clear"),
        F.least(known(blocks_count), F.lit(float(MAX_AHEAD))) / F.lit(float(MAX_AHEAD)),
        clip(known(adherence) / F.lit(ADHERENCE_SCALE_SEC), -1.0, 1.0),
        clip(known(grade) / F.lit(GRADE_SCALE_PCT), -1.0, 1.0),
        known(block_idx) / F.lit(float(cfg.n_blocks - 1)),
    )


def rule_policy(obs: Column) -> Column:
    """Fixed three-aspect policy: an action id from the one-hot aspect."""
    is_stop = obs[OBSERVATION.index("is_stop")] > 0.5
    is_approach = obs[OBSERVATION.index("is_approach")] > 0.5
    return F.when(is_stop, STOP_ACTION).when(is_approach, APPROACH_ACTION).otherwise(FREE_ACTION)


def argmax_action(logits: Column) -> Column:
    """Index of the largest value, the first one on a tie."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def target_speed(action: Column, targets: Sequence[float] = SPEED_TARGETS_MPH) -> Column:
    """Speed in mph an action stands for."""
    return F.element_at(F.array(*(F.lit(float(t)) for t in targets)), action + 1)
