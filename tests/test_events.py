"""Edge rows of parsing and validation."""

import pytest

from corridor.operators.events import explode_blocks_ahead, parse_events, validate_events, with_event_time
from corridor.schema import SILVER_EVENT, TRAIN_EVENT
from corridor.sources.log import to_keyed_json

GOOD = dict(
    event_id="E",
    timestamp_utc="2026-05-07T12:00:01+00:00",
    train_id="T_001",
    block_id="B_001",
    block_idx=0,
    subdivision="S",
    current_speed_mph=10.0,
    max_authorized_speed_mph=79.0,
    gross_tonnage=1,
    signal_aspect_ahead="clear",
    blocks_ahead_occupied=[],
    schedule_adherence_sec=0.0,
    track_grade_pct=0.0,
)


def kept(spark, **changes):
    df = spark.createDataFrame([tuple((GOOD | changes).values())], TRAIN_EVENT)
    return validate_events(df).count()


@pytest.mark.parametrize("text", [b"{bad", b"[1]", b"", None])
def test_malformed_json_is_a_null_row(spark, text):
    (row,) = parse_events(spark.createDataFrame([(text,)], "value binary")).collect()
    assert set(row.asDict().values()) == {None}


def test_bad_field_is_null(spark):
    raw = [(b'{"train_id":"T","current_speed_mph":"zz","block_idx":2.5}',)]
    (row,) = parse_events(spark.createDataFrame(raw, "value binary")).collect()
    assert (row.current_speed_mph, row.block_idx) == (None, None)


def test_timestamps(spark):
    texts = ["2026-05-07T12:00:01+00:00", "2026-05-07T12:00:01.123456+00:00", "nope", None]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp_utc string")
    got = with_event_time(df).selectExpr("cast(event_time as string) t").collect()
    assert [r.t for r in got] == ["2026-05-07 12:00:01", "2026-05-07 12:00:01.123456", None, None]


@pytest.mark.parametrize(
    "column, value, n",
    [
        ("current_speed_mph", 0.0, 1),
        ("current_speed_mph", 79.0, 1),
        ("current_speed_mph", 79.1, 0),
        ("current_speed_mph", -0.1, 0),
        ("current_speed_mph", float("nan"), 0),
        ("current_speed_mph", None, 0),
        ("block_idx", 19, 1),
        ("block_idx", 20, 0),
        ("block_idx", -1, 0),
        ("block_idx", None, 0),
        ("signal_aspect_ahead", "CLEAR", 0),
        ("signal_aspect_ahead", None, 0),
        ("schedule_adherence_sec", None, 1),
        ("train_id", None, 0),
        ("block_id", None, 0),
        ("timestamp_utc", "nope", 0),
    ],
)
def test_validation(spark, column, value, n):
    assert kept(spark, **{column: value}) == n


def test_blocks_ahead_rows(spark):
    ahead = [("B_002", "T_002", 60.0), ("B_003", "T_003", 70.0)]
    df = spark.createDataFrame(
        [tuple((GOOD | {"blocks_ahead_occupied": ahead}).values())], TRAIN_EVENT
    )
    got = explode_blocks_ahead(with_event_time(df)).collect()
    assert [(r.ahead_block_id, r.occupying_train) for r in got] == [x[:2] for x in ahead]


def test_parser_runs_once_per_row(spark):
    raw = spark.createDataFrame([(b"{}",)], "value binary")
    plan = validate_events(parse_events(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_keyed_json_keeps_nulls_and_keys(spark):
    df = spark.createDataFrame([("T_001", None)], "train_id string, x int")
    (row,) = to_keyed_json(df).collect()
    assert bytes(row.key) == b"T_001" and bytes(row.value) == b'{"train_id":"T_001","x":null}'


def test_silver_schema(layers):
    assert layers.silver.schema.fieldNames() == SILVER_EVENT.fieldNames()
