"""Reward of one step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corridor.config import DEFAULT
from corridor.functions.policy import ADHERENCE_SCALE_SEC, clip, known

# Weights and limits of the reward.
BRAKING_WEIGHT = 0.3
FREE_RUN_WEIGHT = 0.1
REWARD_RANGE = (-2.0, 1.0)


def step_reward(
    adherence: Column,
    speed: Column,
    previous_speed: Column,
    signal: Column,
    max_speed: float = DEFAULT.max_speed_mph,
) -> Column:
    """Punctuality minus braking, plus running fast on a clear signal; clipped."""
    limit = F.lit(float(max_speed))
    now = speed.cast("double")
    off_schedule = -F.abs(known(adherence)) / F.lit(ADHERENCE_SCALE_SEC)
    lost = F.greatest(F.lit(0.0), previous_speed.cast("double") - now)
    braking = F.lit(BRAKING_WEIGHT) * lost / limit
    free_run = F.when(signal == "clear", F.lit(FREE_RUN_WEIGHT) * (now / limit)).otherwise(0.0)
    return clip(off_schedule - braking + free_run, *REWARD_RANGE)
