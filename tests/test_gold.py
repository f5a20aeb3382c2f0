"""Windows, delays and advice on hand-written rows."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.operators.advisories import with_advisories, with_blocks_count
from corridor.operators.occupancy import occupancy
from corridor.schema import OCCUPANCY, SILVER_EVENT

T0 = datetime(2026, 1, 1)


def silver_row(second, event_id="E", adherence=1.0, train="T_001"):
    return (
        event_id, "", train, "B_001", 0, "S", 10.0, 79.0, 1, "clear", [], adherence, 0.0,
        T0.replace(second=second),
    )


def gold_row(spark, signal, speed, adherence):
    row = (T0, T0, "T_001", "B_001", 0, signal, speed, adherence, 0.0)
    return with_advisories(spark.createDataFrame([row], OCCUPANCY)).first()


@pytest.mark.parametrize(
    "signal, speed, adherence, delay, severity",
    [
        ("stop", 0.0, -100.0, 280.0, "critical"),
        ("approach", 79.0, 50.0, 30.0, "nominal"),
        ("stop", 79.0, -60.0, 180.0, "moderate"),
        ("stop", 79.0, 0.0, 120.0, "moderate"),
        ("clear", 79.0, -600.0, 60.0, "nominal"),
        ("stop", 79.0, None, 120.0, "moderate"),
        (None, 79.0, -100.0, 10.0, "nominal"),
        ("flashing", 79.0, -100.0, 10.0, "nominal"),
    ],
)
def test_shockwave(spark, signal, speed, adherence, delay, severity):
    row = gold_row(spark, signal, speed, adherence)
    assert (row.shockwave_delay_sec, row.delay_severity) == (delay, severity)


def test_advice(spark):
    advice = {s: gold_row(spark, s, 50.0, 0.0).advisory_speed_mph for s in ("stop", "approach", "x")}
    assert advice == {"stop": 0.0, "approach": 30.0, "x": 79.0}


def test_event_falls_into_three_windows(spark):
    got = occupancy(spark.createDataFrame([silver_row(10)], SILVER_EVENT)).collect()
    starts = sorted(r.window_start for r in got)
    assert starts == [datetime(2025, 12, 31, 23, 59, 50), T0, T0.replace(second=10)]


def test_newest_event_wins_whole_and_nulls_stay(spark):
    data = [silver_row(11, "A"), silver_row(12, "B", None), silver_row(12, "A", 5.0)]
    got = occupancy(spark.createDataFrame(data, SILVER_EVENT)).where(
        F.col("window_start") == F.lit(T0)
    )
    assert got.first().schedule_adherence_sec is None


def test_order_and_partitions_do_not_matter(layers):
    shuffled = layers.silver.orderBy(F.rand(7)).repartition(13)
    assert rows(occupancy(shuffled)) == rows(layers.occupancy)


def test_blocks_count(spark):
    df = spark.createDataFrame([("stop",), ("approach",), ("clear",), (None,)], "signal_aspect string")
    assert [r.blocks_count for r in with_blocks_count(df).collect()] == [1, 1, 0, 0]


def test_gold_has_no_python_stage(layers):
    plan = with_advisories(occupancy(layers.silver))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
