"""Stages as a user starts them, graceful stop, and failure of one of several queries."""

import json
import os
import signal
import subprocess
import sys
import threading
import time

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corridor import jobs as cli
from corridor.operators.evaluation import step_rewards
from corridor.operators.scoring import score_policy, with_features
from corridor.plans.layers import example_network
from corridor.schema import GOLD, OCCUPANCY, SILVER_EVENT, TRAIN_EVENT
from corridor.session import new_path
from corridor.sources import tables
from corridor.sources.folders import Folder
from corridor.streaming import jobs, sinks

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(spark, monkeypatch, stage, source, out, *more):
    """One stage over all that is there, in this session."""
    monkeypatch.setattr(signal, "signal", lambda *_: None)
    args = ["--out", f"{out}/{stage}", "--checkpoint", f"{out}/c-{stage}", "--available-now"]
    code = cli.main([stage, "--source", source, *args, "--state-partitions", "4", *more])
    assert code == 0
    return f"{out}/{stage}"


def test_all_stages_one_after_another(spark, layers, monkeypatch):
    out = new_path(spark, "stages")
    layers.log.drop("n").write.parquet(f"{out}/log")
    bronze = run(spark, monkeypatch, "bronze", f"{out}/log", out)
    assert rows(tables.read_table(spark, bronze, schema=TRAIN_EVENT)) == rows(layers.bronze)
    silver = run(spark, monkeypatch, "silver", bronze, out, "--occupancy-out", f"{out}/occ")
    assert rows(tables.read_table(spark, silver, schema=SILVER_EVENT)) == rows(layers.silver)
    both = run(spark, monkeypatch, "tables", bronze, out)
    assert rows(jobs.read_silver_and_occupancy(spark, both)[1]) == rows(layers.occupancy)
    updates = run(spark, monkeypatch, "occupancy-update", bronze, out)
    assert rows(sinks.read_upserted(spark, updates, jobs.occupancy_keys())) == rows(layers.occupancy)
    gold = run(spark, monkeypatch, "gold", f"{out}/occ", out)
    closed = tables.read_table(spark, gold, schema=GOLD)
    newest = layers.silver.agg(F.max("event_time")).first()[0]
    passed = F.lit(newest) - F.expr("interval 30 seconds")
    assert rows(closed) == rows(layers.gold.where(F.col("window_end") <= passed))
    network = [{"weights": la.weights, "bias": la.bias} for la in example_network()]
    Folder(spark, out).write("network.json", json.dumps({"layers": network}))
    scored = run(spark, monkeypatch, "scored", gold, out, "--network", f"{out}/network.json")
    want = score_policy(with_features(closed), example_network()).drop("obs")
    assert rows(sinks.read_batches(spark, scored).drop("stored_batch")) == rows(want)
    steps = run(spark, monkeypatch, "step-rewards", bronze, out)
    want = step_rewards(layers.silver).where(F.col("event_time") <= passed)
    assert rows(tables.read_table(spark, steps)) == rows(want)


@pytest.mark.parametrize("argv", [["silver", "--source", "a"], ["scored", "--source", "a"], ["gold"]])
def test_missing_options_are_told(argv, capsys):
    with pytest.raises(SystemExit) as stopped:
        cli.main([*argv, "--out", "o", "--checkpoint", "c"])
    assert stopped.value.code == 2 and "usage" in capsys.readouterr().err


def streams(spark, out, fail=False):
    """Two endless queries, of which the second may fail."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    broken = F.raise_error(F.lit("broken on purpose")).cast("bigint")
    value = F.when(F.col("value") > 20, broken).otherwise(F.col("value")) if fail else F.col("value")
    trigger = {"processingTime": "200 milliseconds"}
    return [
        sinks.write_append(rate, f"{out}/a", f"{out}/ca", trigger=trigger),
        sinks.write_append(rate.withColumn("value", value), f"{out}/b", f"{out}/cb", trigger=trigger),
    ]


def test_stop_lets_batches_end(spark):
    queries, stop = streams(spark, new_path(spark, "stop")), threading.Event()
    threading.Timer(3, stop.set).start()
    jobs.run_until_stopped(queries, stop, poll_sec=0.1)
    assert not any(q.isActive for q in queries)
    assert all(q.exception() is None for q in queries)


def test_one_failure_ends_all(spark):
    queries = streams(spark, new_path(spark, "fail"), fail=True)
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        jobs.run_until_stopped(queries, threading.Event(), poll_sec=0.1)
    assert not any(q.isActive for q in queries)


def test_a_process_ends_on_a_signal(spark, layers, tmp_path):
    out = new_path(spark, "process")
    layers.log.drop("n").write.parquet(f"{out}/log")
    command = [sys.executable, "-m", "corridor.jobs", "bronze", "--source", f"{out}/log"]
    command += ["--out", f"{out}/bronze", "--checkpoint", f"{out}/c", "--every", "200 milliseconds"]
    process = subprocess.Popen(command, cwd=REPO, stderr=subprocess.PIPE, stdout=subprocess.PIPE)
    try:
        deadline = time.monotonic() + 90
        while not Folder(spark, f"{out}/c/commits").has("0"):
            assert process.poll() is None and time.monotonic() < deadline, process.stderr.read()
            time.sleep(0.2)
        process.send_signal(signal.SIGTERM)
        assert process.wait(60) == 0
    finally:
        process.kill()
    assert tables.read_table(spark, f"{out}/bronze", schema=TRAIN_EVENT).count() == layers.bronze.count()
