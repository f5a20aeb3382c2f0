"""Table checks: one aggregate, hence one scan, per table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.config import DEFAULT, SEVERITIES, CorridorConfig
from corridor.operators.events import validity, with_event_time

def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that break each rule; null is no violation."""
    return df.agg(*(F.count_if(broken).alias(name) for name, broken in rules.items()))


def outside(value: Column, low: float, high: float) -> Column:
    """Out of the closed range."""
    return (value < low) | (value > high)


def not_among(value: Column, allowed: Sequence[str]) -> Column:
    """A known value that is not allowed."""
    return ~value.isin(*allowed)


class LayerCheck(NamedTuple):
    """What is checked of a layer: columns that must be there, and rules.

    A rule is given which rows belong to the layer and returns an aggregate that counts
    what is wrong among them.
    """

    layer: str
    required: tuple[str, ...]
    rules: dict[str, Callable[[Column], Column]]


def _broken(found: Column) -> Callable[[Column], Column]:
    return lambda rows: F.count_if(rows & found)


def _trains_off(cfg: CorridorConfig) -> Callable[[Column], Column]:
    """Distance to the expected number of trains; a null train id is one more train."""

    def rule(rows: Column) -> Column:
        trains = F.count_distinct(F.when(rows, F.col("train_id")))
        unnamed = F.max(rows & F.col("train_id").isNull()).cast("int")
        return F.abs(trains + F.coalesce(unnamed, F.lit(0)) - cfg.expected_trains)

    return rule


# The columns that each layer must have.
BRONZE_COLUMNS = (
    "train_id",
    "block_id",
    "signal_aspect_ahead",
    "current_speed_mph",
    "schedule_adherence_sec",
)
SILVER_COLUMNS = ("event_time",)
OCCUPANCY_COLUMNS = ("window_start", "window_end", "train_id")
GOLD_COLUMNS = ("shockwave_delay_sec", "advisory_speed_mph", "delay_severity")


def layer_checks(cfg: CorridorConfig = DEFAULT) -> dict[str, LayerCheck]:
    """The checks of the four layers."""
    bad_signal = not_among(F.col("signal_aspect_ahead"), cfg.aspects)
    bad_speed = outside(F.col("current_speed_mph"), 0, cfg.max_speed_mph)
    bad_severity = not_among(F.col("delay_severity"), SEVERITIES)
    bad_advice = outside(F.col("advisory_speed_mph"), 0, cfg.max_speed_mph)
    checks = (
        LayerCheck("bronze", BRONZE_COLUMNS, {"train_id_known": _broken(F.col("train_id").isNull())}),
        LayerCheck(
            "silver",
            SILVER_COLUMNS,
            {"aspects_valid": _broken(bad_signal), "speeds_in_range": _broken(bad_speed)},
        ),
        LayerCheck("occupancy", OCCUPANCY_COLUMNS, {"trains_expected": _trains_off(cfg)}),
        LayerCheck(
            "gold",
            GOLD_COLUMNS,
            {"severities_valid": _broken(bad_severity), "advisories_in_range": _broken(bad_advice)},
        ),
    )
    return {check.layer: check for check in checks}


def _report(df: DataFrame, *layers: tuple[LayerCheck, Column]) -> DataFrame:
    """Rows ``(layer, check_name, passed, n_rows, n_bad)`` of layers that ``df`` holds.

    One aggregate for all of them. Each layer comes with the condition for its rows; its
    lines are the row count, the columns, then the rules.
    """
    aggregates, lines = [], []
    for check, rows in layers:
        total = f"{check.layer}_rows"
        missing = len([c for c in check.required if c not in df.columns])
        aggregates.append(F.count_if(rows).alias(total))
        bad = {
            "rows_present": F.when(F.col(total) > 0, 0).otherwise(1),
            "columns_present": F.lit(missing),
        }
        for name, rule in check.rules.items():
            aggregates.append(rule(rows).alias(f"{check.layer}_{name}"))
            bad[name] = F.col(f"{check.layer}_{name}")
        lines += [
            F.struct(
                F.lit(check.layer).alias("layer"),
                F.lit(name).alias("check_name"),
                (n == 0).alias("passed"),
                F.col(total).alias("n_rows"),
                n.cast("bigint").alias("n_bad"),
            )
            for name, n in bad.items()
        ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def check_bronze(bronze: DataFrame) -> DataFrame:
    return _report(bronze, (layer_checks()["bronze"], F.lit(True)))


def check_silver(silver: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    return _report(silver, (layer_checks(cfg)["silver"], F.lit(True)))


def check_occupancy(occupancy: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """A null train id counts as one more train."""
    return _report(occupancy, (layer_checks(cfg)["occupancy"], F.lit(True)))


def check_gold(gold: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    return _report(gold, (layer_checks(cfg)["gold"], F.lit(True)))


def _is_valid(cfg: CorridorConfig) -> Column:
    return reduce(lambda a, b: a & b, validity(cfg))


def derived_report(
    bronze: DataFrame, gold: DataFrame, cfg: CorridorConfig = DEFAULT
) -> DataFrame:
    """``dq_report`` where Silver and occupancy are not stored but derived.

    Silver is the valid part of Bronze, and Gold has a row for every row of occupancy:
    two aggregates see all four layers, and each parsed input is read once.
    """
    checks = layer_checks(cfg)
    events = _report(
        with_event_time(bronze), (checks["bronze"], F.lit(True)), (checks["silver"], _is_valid(cfg))
    )
    windows = _report(gold, (checks["occupancy"], F.lit(True)), (checks["gold"], F.lit(True)))
    return _with_total(events.unionByName(windows))


def derived_counts(bronze: DataFrame, gold: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Rows of the four layers, derived as in ``derived_report``."""

    def lines(df: DataFrame, **tables: Column) -> DataFrame:
        counts = df.agg(*(F.count_if(rows).alias(name) for name, rows in tables.items()))
        pairs = (F.struct(F.lit(t).alias("table_name"), F.col(t).alias("n_rows")) for t in tables)
        return counts.select(F.inline(F.array(*pairs)))

    events = lines(with_event_time(bronze), bronze=F.lit(True), silver=_is_valid(cfg))
    return events.unionByName(lines(gold, occupancy=F.lit(True), gold=F.lit(True)))


def dq_report(
    bronze: DataFrame,
    silver: DataFrame,
    occupancy: DataFrame,
    gold: DataFrame,
    cfg: CorridorConfig = DEFAULT,
) -> DataFrame:
    """All checks of four stored tables plus one ``(all, failed_checks)`` row that sums the failures."""
    parts = [
        check_bronze(bronze),
        check_silver(silver, cfg),
        check_occupancy(occupancy, cfg),
        check_gold(gold, cfg),
    ]
    return _with_total(reduce(DataFrame.unionByName, parts))


def _with_total(checks: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("passed"))
    is_total = F.grouping("check_name") == 1
    return checks.groupingSets(
        [[F.col("layer"), F.col("check_name")], []], F.col("layer"), F.col("check_name")
    ).agg(
        F.when(is_total, "all").otherwise(F.col("layer")).alias("_layer"),
        F.when(is_total, "failed_checks").otherwise(F.col("check_name")).alias("_check"),
        (failed == 0).alias("passed"),
        failed.alias("n_failed"),
        F.sum("n_bad").alias("n_bad"),
    ).select(
        F.col("_layer").alias("layer"),
        F.col("_check").alias("check_name"),
        "passed",
        "n_failed",
        "n_bad",
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
