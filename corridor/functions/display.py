"""Labels, colours and number texts for the serving tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the serving tables show per code.
GREEN = "#16a34a"
AMBER = "#ca8a04"
RED = "#dc2626"
DARK_GREEN = "#166534"
GREY = "#6b7280"
PURPLE = "#7c3aed"
ASPECT_COLOUR = {"clear": GREEN, "approach": AMBER, "stop": RED}
ASPECT_LABEL = {"clear": "CLR", "approach": "APP", "stop": "STP"}
ASPECT_ICON = {"clear": "🟢", "approach": "🟡", "stop": "🔴"}
SEVERITY_COLOUR = {"nominal": GREEN, "moderate": AMBER, "critical": RED}
SEVERITY_MARKER = {"nominal": "circle", "moderate": "diamond", "critical": "x"}
TRAIN_COLOUR = {
    "T_001": "#3b82f6",
    "T_002": "#10b981",
    "T_003": "#f59e0b",
    "T_004": "#8b5cf6",
    "T_005": "#ef4444",
}
RULE_SPEED_MPH = {"stop": 0.0, "approach": 20.0, "clear": 79.0}
LATE_BELOW_SEC = -60


def code_lookup(code: Column, table: dict, default) -> Column:
    """Value of ``code`` in a small fixed table, or the default."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), F.lit(default))


def normalise_code(code: Column, default: str) -> Column:
    """Trimmed lower-case code; null and empty text become the default."""
    return F.lower(F.trim(F.coalesce(F.nullif(code, F.lit("")), F.lit(default))))


def whole_number(x: Column) -> Column:
    """Text of ``x`` without decimals: half to even, and ``-0`` for small negatives."""
    rounded = F.bround(x.cast("double"), 0)
    text = rounded.cast("bigint").cast("string")
    return F.when((x < 0) & (rounded == 0), "-0").otherwise(text)


def adherence_label(adherence: Column) -> Column:
    """Signed seconds, such as ``+12s``."""
    sign = F.when(adherence >= 0, "+").otherwise("")
    return F.concat(sign, whole_number(adherence), F.lit("s"))
