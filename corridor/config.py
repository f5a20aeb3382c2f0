"""Corridor parameters. All operators take them through ``CorridorConfig``."""

from __future__ import annotations

from dataclasses import dataclass

# The limits, names and thresholds results have to agree on.
ASPECTS = ("clear", "approach", "stop")
SEVERITIES = ("nominal", "moderate", "critical")
SUBDIVISION = "Harrisburg_Sub"
TOPIC = "train_events"
SPEED_TARGETS_MPH = (0.0, 20.0, 40.0, 60.0, 79.0)


@dataclass(frozen=True)
class CorridorConfig:
    """Limits of one kind of corridor; the defaults are the standard corridor."""

    n_blocks: int = 20
    max_speed_mph: float = 79.0
    aspects: tuple[str, ...] = ASPECTS
    watermark_sec: int = 30
    window_sec: int = 30
    slide_sec: int = 10
    expected_trains: int = 5
    episode_steps: int = 200
    #: Columns that identify one train. A fleet over many corridors adds
    #: ``subdivision``.
    keys: tuple[str, ...] = ("train_id",)

    @property
    def snapshot_keys(self) -> tuple[str, ...]:
        """Columns that identify one consistent picture of one corridor."""
        return (*(k for k in self.keys if k != "train_id"), "window_start")


DEFAULT = CorridorConfig()
FLEET = CorridorConfig(keys=("subdivision", "train_id"))
