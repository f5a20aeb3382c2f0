"""Delay, severity and rule-based speed advice as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corridor.config import DEFAULT

# What each aspect adds to a train's own lateness, by how much a slow train
# adds more, severity limits, and the share of its speed a train keeps at approach.
STOP_SEC = 120.0
STOP_SLOW_SEC = 60.0
APPROACH_LATENESS_SHARE = 0.5
APPROACH_SEC = 30.0
APPROACH_SLOW_SEC = 20.0
OPEN_TRACK_LATENESS_SHARE = 0.1
CRITICAL_ABOVE_SEC = 180.0
MODERATE_ABOVE_SEC = 60.0
APPROACH_SPEED_SHARE = 0.6


def base_lateness(adherence: Column) -> Column:
    """Seconds behind schedule; 0 for early, punctual and unknown trains."""
    return F.abs(F.least(adherence, F.lit(0.0)))


def speed_factor(speed: Column, max_speed: float = DEFAULT.max_speed_mph) -> Column:
    """0 at line speed, 1 at standstill."""
    limit = F.lit(float(max_speed))
    return F.greatest(F.lit(0.0), (limit - speed) / limit)


def shockwave_delay(signal: Column, lateness: Column, slowness: Column) -> Column:
    """Delay a train passes upstream. Unknown aspects count as open track."""
    at_stop = lateness + F.lit(STOP_SEC) + slowness * F.lit(STOP_SLOW_SEC)
    at_approach = (
        lateness * F.lit(APPROACH_LATENESS_SHARE)
        + F.lit(APPROACH_SEC)
        + slowness * F.lit(APPROACH_SLOW_SEC)
    )
    on_open_track = lateness * F.lit(OPEN_TRACK_LATENESS_SHARE)
    return (
        F.when(signal == "stop", at_stop)
        .when(signal == "approach", at_approach)
        .otherwise(on_open_track)
    )


def advisory_speed(
    signal: Column, speed: Column, max_speed: float = DEFAULT.max_speed_mph
) -> Column:
    """Rule-based target speed in mph."""
    return (
        F.when(signal == "stop", F.lit(0.0))
        .when(signal == "approach", speed * F.lit(APPROACH_SPEED_SHARE))
        .otherwise(F.lit(float(max_speed)))
    )


def delay_severity(delay: Column) -> Column:
    """Severity class; limits are exclusive and an unknown delay is nominal."""
    return (
        F.when(delay > CRITICAL_ABOVE_SEC, "critical")
        .when(delay > MODERATE_ABOVE_SEC, "moderate")
        .otherwise("nominal")
    )
