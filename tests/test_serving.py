"""Serving tables, texts and file sources."""

import shutil
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corridor.functions import display
from corridor.operators import quality, serving
from corridor.operators.advisories import with_advisories
from corridor.plans import dashboard
from corridor.plans.layers import Layers
from corridor.schema import GOLD, OCCUPANCY
from corridor.session import new_path
from corridor.sources import tables
from corridor.streaming.sinks import write_append

T0 = datetime(2026, 1, 1)


def gold(spark, *states):
    """States are ``(train, second, block, signal, speed, adherence)``."""
    data = [
        (T0 + timedelta(seconds=s), T0, t, f"B_{b:03d}", b - 1, sig, v, adh, 0.0)
        for t, s, b, sig, v, adh in states
    ]
    return with_advisories(spark.createDataFrame(data, OCCUPANCY))


def test_latest_takes_last_known_value_per_column(spark):
    df = gold(spark, ("T_001", 0, 1, "clear", 1.0, 7.0), ("T_001", 10, 2, "stop", 2.0, None))
    row = serving.latest_per_train(df).first()
    assert (row.block_id, row.schedule_adherence_sec) == ("B_002", 7.0)


def test_track_map_shows_last_train(spark):
    df = gold(spark, ("T_004", 0, 7, "stop", 0.5, 0.0), ("T_002", 0, 7, "clear", 9.0, 0.0))
    blocks = {r.block_id: r for r in serving.track_map(df).collect()}
    assert len(blocks) == 20
    assert (blocks["B_007"].train_id, blocks["B_007"].label) == ("T_004", "STP")
    assert blocks["B_007"].speed == "0 mph" and blocks["B_001"].label == "CLEAR"


def test_block_dimension_is_broadcast(spark, layers):
    plan = serving.track_map(serving.latest_per_train(layers.gold))
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("advised, source", [(25.0, "STD"), (25.1, "RL")])
def test_overlay_tolerance(spark, advised, source):
    df = gold(spark, ("T_001", 0, 1, "approach", 9.0, 0.0)).withColumn("a", F.lit(advised))
    row = serving.rl_overlay(df, "a").where("train_id is not null").first()
    assert row.source == source


def test_whole_number_texts(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (-0.4,), (-1.5,), (12.0,)], "x double")
    got = [r[0] for r in df.select(display.adherence_label(F.col("x"))).collect()]
    assert got == ["+0s", "+2s", "-0s", "-2s", "+12s"]


def test_missing_columns(spark):
    df = spark.createDataFrame([("T_001",)], "train_id string")
    assert tuple(serving.corridor_summary(df).first()) == (0.0, 0.0, 0, 0.0, 1)
    row = serving.advisory_feed(df).first()
    assert (row.signal, row.block_id, row.advisory) == ("CLEAR", "?", "79 mph")
    assert serving.latest_per_train(df).columns == ["train_id"]


def test_recent_files(spark):
    path = new_path(spark, "files")
    for i in range(4):
        part = spark.range(i, i + 1).withColumn("extra", F.lit(1)) if i == 3 else spark.range(i, i + 1)
        part.coalesce(1).write.parquet(f"{path}/d{i}")
    got = tables.read_recent_files(spark, path, 2)
    assert sorted(map(tuple, got.collect())) == [(2, None), (3, 1)]
    # The extra empty partition of a range writes no file.
    assert tables.list_files(spark, path).count() == 4


def test_fallback(spark):
    base = new_path(spark, "fallback")
    df, sample = tables.read_with_fallback(spark, f"{base}/a", f"{base}/b", GOLD)
    assert (df.count(), sample, df.schema) == (0, False, GOLD)
    spark.range(3).write.parquet(f"{base}/b")
    df, sample = tables.read_with_fallback(spark, f"{base}/a", f"{base}/b", GOLD)
    assert (df.count(), sample) == (3, True)
    spark.range(5).write.parquet(f"{base}/a/deep")
    df, sample = tables.read_with_fallback(spark, f"{base}/a", f"{base}/b", GOLD)
    assert (df.count(), sample) == (5, False)


def test_files_of_a_failed_attempt_do_not_count(spark):
    """A file sink's folder with files that no batch has committed, the newest of all."""
    base = new_path(spark, "sink")
    for i in range(12):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", "1").parquet(f"{base}/in")
    write_append(stream, f"{base}/t", f"{base}/c").awaitTermination()
    spark.range(100, 103).write.parquet(f"{base}/stray")
    strays = [r.path for r in tables.list_files(spark, f"{base}/stray").select("path").collect()]
    for i, path in enumerate(strays):
        shutil.copy(path.removeprefix("file:"), f"{base.removeprefix('file:')}/t/part-stray-{i}.parquet")
    assert tables.list_files(spark, f"{base}/t").count() == 12
    got = tables.read_recent_files(spark, f"{base}/t", 3)
    assert got.count() == 3 and got.agg(F.max("id")).first()[0] < 12
    state, is_sample = tables.read_with_fallback(spark, f"{base}/t", f"{base}/none", GOLD, n=50)
    assert (state.count(), is_sample) == (12, False)


def test_folders_below_the_sample_do_not_count(spark):
    base = new_path(spark, "nested")
    spark.range(2).coalesce(1).write.parquet(f"{base}/sample")
    spark.range(9).coalesce(1).write.parquet(f"{base}/sample/older")
    for n in (None, 1, 8):
        df, is_sample = tables.read_with_fallback(spark, f"{base}/none", f"{base}/sample", GOLD, n)
        assert (df.count(), is_sample) == (2, True)
    spark.range(9).coalesce(1).write.parquet(f"{base}/primary/deep/er")
    for n in (None, 1, 8):
        df, is_sample = tables.read_with_fallback(spark, f"{base}/primary", f"{base}/sample", GOLD, n)
        assert (df.count(), is_sample) == (9, False)


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_reports_parse_each_input_once(layers):
    report = quality.derived_report(layers_of(layers).bronze, layers_of(layers).gold)
    counts = quality.derived_counts(layers_of(layers).bronze, layers_of(layers).gold)
    assert parses(report) == 2 and parses(counts) == 2


def layers_of(stored):
    """The same layers, not stored."""
    return Layers(stored.spark, stored.sf_dir)


def test_the_report_in_one_pass_equals_that_of_stored_tables(layers):
    apart = quality.dq_report(layers.bronze, layers.silver, layers.occupancy, layers.gold)
    assert rows(quality.derived_report(layers.bronze, layers.gold)) == rows(apart)
    tables_ = {n: getattr(layers, n) for n in ("bronze", "silver", "occupancy", "gold")}
    assert rows(quality.derived_counts(layers.bronze, layers.gold)) == rows(quality.table_counts(tables_))


def test_the_report_of_empty_layers(spark, layers):
    report = quality.derived_report(layers.bronze.limit(0), layers.gold.limit(0))
    failed = {(r.layer, r.check_name) for r in report.where("not passed").collect()}
    assert failed == {
        *((layer, "rows_present") for layer in ("bronze", "silver", "occupancy", "gold")),
        ("occupancy", "trains_expected"),
        ("all", "failed_checks"),
    }


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats(spark, fmt):
    path = new_path(spark, fmt)
    tables.write_table(spark.range(3), path, fmt)
    assert tables.read_table(spark, path, fmt).count() == 3


def test_checks_scan_each_layer_once(layers):
    plan = quality.check_gold(layers.gold)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_occupancy_check_counts_a_null_train(spark):
    df = spark.createDataFrame([(t,) for t in ["a", "b", "c", "d", None]], "train_id string")
    row = quality.check_occupancy(df).where("check_name = 'trains_expected'").first()
    assert row.passed


def test_dashboard_loads_state_and_history(spark, layers):
    base = new_path(spark, "dashboard")
    for i in range(9):
        part = gold(spark, ("T_001", i, i + 1, "clear", 1.0, 0.0), (f"T_9{i}", i, 1, "stop", 0.0, 0.0))
        part.coalesce(1).write.parquet(f"{base}/gold/{i}")
    state, is_sample = dashboard.load_state(spark, f"{base}/gold", f"{base}/none")
    trains = {r.train_id: r.block_id for r in state.collect()}
    # Nine files: the oldest is not part of the state, but of the history.
    assert (len(trains), trains["T_001"], is_sample) == (9, "B_009", False)
    assert dashboard.load_history(spark, f"{base}/gold", f"{base}/none").count() == 18
