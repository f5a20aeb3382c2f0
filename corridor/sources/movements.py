"""Train-movement rows derived from the generic ``events`` table.

A pure projection: every event becomes one keyed JSON row with the shape Spark's
Kafka source has. Some rows are given typical faults on purpose (late, malformed,
out of range, missing fields), so that parsing and validation have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corridor.config import SUBDIVISION, TOPIC

# Fixed values of the derivation: every period-th event gets the fault.
FAULT_PERIOD = {
    "no_train": 47,
    "off_corridor": 53,
    "bad_time": 59,
    "malformed": 61,
    "no_block": 67,
    "no_signal": 71,
    "unknown_signal": 41,
    "no_speed": 73,
    "overspeed": 43,
    "negative_speed": 83,
    "no_adherence": 79,
    "late": 97,
}
# The columns used; naming them saves reading file footers for the schema.
EVENTS = "event_id bigint, user_id bigint, event_type string, value double"
FIRST_SECOND = 1704067200  # 2024-01-01T00:00:00Z
TICK_SECONDS = 2
LATE_SECONDS = 45
TRAINS = 5
RING = 20


def _has(fault: str) -> str:
    return f"n % {FAULT_PERIOD[fault]} = 0"


def _padded(prefix: str, number: str, width: int) -> str:
    """The number with at least ``width`` digits; longer ones stay whole."""
    digits = f"cast({number} as string)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def train_events(spark: SparkSession, sf_dir: str, fleet: bool = False) -> DataFrame:
    """Typed train events plus the delivery columns ``n``, ``tick`` and ``tr``."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    placed = (
        events.selectExpr(
            "event_id as n",
            f"event_id div {TRAINS} as tick",
            f"cast(event_id % {TRAINS} as int) as tr",
            "user_id",
            "event_type",
            "value",
        )
        .selectExpr(
            "*",
            f"cast((tick div (3 + tr) + 4 * tr) % {RING} as int) as bi",
            f"timestamp_seconds({FIRST_SECOND} + tick * {TICK_SECONDS}"
            f" - if({_has('late')}, {LATE_SECONDS}, 0)) as event_time",
        )
    )
    train, subdivision = _padded("T_", "tr + 1", 3), f"'{SUBDIVISION}'"
    if fleet:
        train = _padded("T_", "user_id + 1", 4)
        subdivision = _padded("Sub_", "user_id % 30", 2)
    ahead = (
        f"struct({_padded('B_', f'(bi + 1) % {RING} + 1', 3)} as block_id,"
        f" {_padded('T_', f'(tr + 1) % {TRAINS} + 1', 3)} as occupying_train,"
        " cast(60 + n % 241 as float) as estimated_clearance_sec)"
    )
    return placed.selectExpr(
        "n",
        "tick",
        "tr",
        f"{_padded('E_', 'n', 12)} as event_id",
        f"if({_has('bad_time')}, 'not-a-date',"
        """ concat(date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00'))"""
        " as timestamp_utc",
        f"if({_has('no_train')}, null, {train}) as train_id",
        f"case when {_has('no_block')} then null when {_has('off_corridor')} then 'B_021'"
        f" else {_padded('B_', 'bi + 1', 3)} end as block_id",
        f"if({_has('off_corridor')}, {RING}, bi) as block_idx",
        f"{subdivision} as subdivision",
        f"cast(case when {_has('no_speed')} then null when {_has('overspeed')} then 85D"
        f" when {_has('negative_speed')} then -1D"
        " else cast(cast(floor(value * 10D) as bigint) % 791 as double) / 10D end as float)"
        " as current_speed_mph",
        "cast(79 as float) as max_authorized_speed_mph",
        "18400 as gross_tonnage",
        f"case when {_has('no_signal')} then null when {_has('unknown_signal')} then 'flashing'"
        " when event_type = 'error' then 'stop'"
        " when event_type in ('purchase', 'signup') then 'approach' else 'clear' end"
        " as signal_aspect_ahead",
        f"if(n % 3 = 0, slice(array({ahead}), 1, 0), array({ahead})) as blocks_ahead_occupied",
        f"cast(if({_has('no_adherence')}, null, (n * 37) % 901 - 600) as float)"
        " as schedule_adherence_sec",
        "cast(cast((n * 13) % 301 - 150 as double) / 100D as float) as track_grade_pct",
    )


def log_rows(spark: SparkSession, sf_dir: str, fleet: bool = False) -> DataFrame:
    """The train events as keyed JSON rows, with ``n`` kept as the delivery order."""
    events = train_events(spark, sf_dir, fleet)
    fields = ", ".join(c for c in events.columns if c not in ("n", "tick", "tr"))
    return events.selectExpr(
        "cast(train_id as binary) as key",
        f"""cast(if({_has("malformed")}, '{{"event_id":', to_json(struct({fields})))"""
        " as binary) as value",
        f"'{TOPIC}' as topic",
        "tr as partition",
        "tick as offset",
        f"timestamp_seconds({FIRST_SECOND} + tick * {TICK_SECONDS}) as timestamp",
        "n",
    )
