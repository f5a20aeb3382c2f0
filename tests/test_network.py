"""Signals and lookahead, with and without hot snapshots."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.config import CorridorConfig
from corridor.operators import network
from corridor.operators.occupancy import occupancy

T0 = datetime(2026, 1, 1)


def snapshot(spark, *trains):
    return spark.createDataFrame(
        [(T0, t, i) for t, i in trains], "window_start timestamp, train_id string, block_idx int"
    )


def test_ring(spark):
    s = snapshot(spark, ("T_001", 19), ("T_002", 0), ("T_003", 17))
    got = {r.train_id: r.derived_aspect for r in network.derive_signals(s).collect()}
    assert got == {"T_001": "stop", "T_002": "clear", "T_003": "approach"}
    assert network.blocks_ahead(s).select("train_id").distinct().collect()[0][0] == "T_003"
    wrapped = {(r.train_id, r.occupying_train) for r in network.blocks_ahead(s, wrap=True).collect()}
    assert wrapped == {("T_001", "T_002"), ("T_003", "T_001")}


def test_long_corridor(spark):
    """More blocks than bits in a word."""
    cfg = CorridorConfig(n_blocks=130)
    s = snapshot(spark, ("T_001", 63), ("T_002", 64), ("T_003", 126), ("T_004", 128), ("T_005", 129))
    got = {r.train_id: r.derived_aspect for r in network.derive_signals(s, cfg).collect()}
    assert got == {
        "T_001": "stop", "T_002": "clear", "T_003": "approach", "T_004": "stop", "T_005": "clear",
    }


def test_last_train_holds_a_shared_block(spark):
    s = snapshot(spark, ("T_001", 5), ("T_002", 6), ("T_004", 6))
    got = {(r.train_id, r.occupying_train) for r in network.blocks_ahead(s).collect()}
    assert got == {("T_001", "T_004")}


def test_counts_and_free_blocks_agree_with_signals(layers):
    signals = network.derive_signals(layers.occupancy)
    free = network.next_block_free(layers.occupancy)
    assert free.count() == signals.where("derived_aspect <> 'stop'").count()
    by = dict(map(tuple, signals.groupBy("derived_aspect").count().collect()))
    assert by == {"stop": 369, "approach": 346, "clear": 1296}
    counted = network.blocks_ahead_count(layers.occupancy)
    assert counted.where("n_ahead = 0").count() == 1296


@pytest.mark.parametrize("op", ["derive_signals", "blocks_ahead_count", "blocks_ahead"])
def test_hot_and_null_snapshots_give_the_same_rows(layers, op):
    """A third of all rows in one snapshot, some in none: other snapshots do not change."""
    one = F.lit(datetime(2030, 1, 1))
    start = F.col("window_start")
    hot = layers.occupancy.withColumn("window_start", F.when(F.xxhash64(start) % 3 == 0, one).otherwise(start))
    hot = hot.withColumn("window_start", F.when(F.minute("window_start") == 7, None).otherwise(F.col("window_start")))
    f = getattr(network, op)
    kept = (start != one) & start.isNotNull()
    expected = f(hot.where(kept))
    assert rows(f(hot).where(kept)) == rows(expected)
    assert f(hot).where(start.isNull()).count() > 0


def test_lookup_reads_the_snapshot_shuffle_once(layers):
    """Rows and per-snapshot values come from the same aggregation."""
    df = network.derive_signals(occupancy(layers.silver))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "CartesianProduct" not in plan


def test_cascade(spark):
    cfg = CorridorConfig()
    df = spark.createDataFrame(
        [(T0, "T_001", 3, "clear", 60.0), (T0, "T_002", 5, "stop", 0.0)],
        "window_start timestamp, train_id string, block_idx int, signal_aspect string, speed_mph float",
    )
    got = {r.train_id: r.cascade_delay_sec for r in network.shockwave_cascade(df, cfg).collect()}
    assert got == {"T_001": 120.0, "T_002": 0.0}


def test_cascade_goes_round_the_ring(spark):
    df = spark.createDataFrame(
        [(T0, "T_001", 19, "clear", 60.0), (T0, "T_002", 0, "stop", 0.0), (T0, "T_003", 17, "clear", 60.0)],
        "window_start timestamp, train_id string, block_idx int, signal_aspect string, speed_mph float",
    )
    near = {r.train_id: r.cascade_delay_sec for r in network.shockwave_cascade(df).collect()}
    assert near == {"T_001": 60.0, "T_002": 0.0, "T_003": 0.0}
    far = {r.train_id: r.cascade_delay_sec for r in network.shockwave_cascade(df, ahead=2).collect()}
    assert far == {"T_001": 60.0, "T_002": 0.0, "T_003": 180.0}
    alone = network.shockwave_cascade(df.where("train_id = 'T_002'")).first()
    assert alone.lead_train is None and alone.cascade_delay_sec == 0.0
