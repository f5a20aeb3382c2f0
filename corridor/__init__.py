"""Spark-native analytics over train-movement events.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that works the same on batch tables and on Structured Streaming.
"""

from corridor.config import DEFAULT, CorridorConfig
from corridor.session import prepare, shared_dir

__all__ = ["DEFAULT", "CorridorConfig", "prepare", "shared_dir"]
