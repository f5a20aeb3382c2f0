"""Features, scoring paths, rewards and episodes."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from corridor.config import CorridorConfig
from corridor.functions import policy as P
from corridor.functions.rewards import step_reward
from corridor.operators import evaluation as ev
from corridor.operators import scoring
from corridor.operators.ordering import number_rows, time_bucket
from corridor.sources.movements import EVENTS, train_events
from corridor.plans.layers import Layers, example_network, wide_network


def features(spark, signal, adherence=0.0):
    df = spark.createDataFrame(
        [(79.0, signal, 1, adherence, 0.0, 19)],
        "speed_mph float, signal_aspect string, blocks_count int, "
        "schedule_adherence_sec float, track_grade_pct float, block_idx int",
    )
    return scoring.with_features(df).first().obs


@pytest.mark.parametrize(
    "signal, hot",
    [(" STOP ", [1, 0, 0]), ("", [0, 0, 1]), (None, [0, 0, 1]), ("x", [0, 0, 0])],
)
def test_signal_features(spark, signal, hot):
    assert features(spark, signal)[1:4] == hot


def test_numeric_features(spark):
    assert features(spark, "clear", -900.0) == [1.0, 0, 0, 1.0, 0.5, -1.0, 0.0, 1.0]
    assert features(spark, "clear", None)[5] == 0.0
    assert features(spark, "clear", float("nan"))[5] == 0.0


def test_argmax_takes_the_first_maximum(spark):
    logits = F.array(*(F.lit(float(x)) for x in (1, 3, 3, 0, 0)))
    action = P.argmax_action(logits)
    assert tuple(spark.range(1).select(action, P.target_speed(action)).first()) == (1, 20.0)


@pytest.mark.parametrize("activation", ["relu", "tanh"])
def test_columns_and_batches_agree(layers, activation):
    columns = scoring.score_columns(layers.featured, example_network(), activation)
    batches = scoring.score_policy(layers.featured, example_network(), activation)
    row = scoring.score_parity(columns, batches, ["window_start", "train_id"]).first()
    assert (row.n_rows, row.n_mismatch, row.matches) == (2011, 0, True)
    assert "Python" not in columns._jdf.queryExecution().executedPlan().toString()


def test_wide_network_equals_plain_loops(layers):
    """64 x 64 units, tanh; every output by sums in Python."""
    network = wide_network()
    got = scoring.score_policy(layers.featured, network, "tanh").select("obs", scoring.SCORE)
    seen = set()
    for obs, speed in got.limit(300).collect():
        x = list(obs)
        for depth, layer in enumerate(network):
            x = [b + sum(w * v for w, v in zip(r, x)) for r, b in zip(layer.weights, layer.bias)]
            if depth < 2:
                x = [math.tanh(v) for v in x]
        assert speed == scoring.SPEED_TARGETS_MPH[x.index(max(x))]
        seen.add(speed)
    assert len(seen) > 1


def test_observations_that_do_not_fit_give_null(spark):
    rows = [(1, [0.0] * 8), (2, None), (3, [1.0]), (4, []), (5, [0.5] * 8)]
    df = spark.createDataFrame(rows, "id int, obs array<double>")
    got = dict(scoring.score_policy(df, example_network()).select("id", scoring.SCORE).collect())
    assert [got[i] is None for i in range(1, 6)] == [False, True, True, True, False]
    assert scoring.score_policy(df.limit(0), example_network()).count() == 0


def test_network_features_take_one_shuffle_by_snapshot(layers):
    featured = scoring.with_network_features(layers.occupancy)
    plan = featured._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(window_start") <= 2 and "Window" not in plan
    aspects = {"stop": 0, "approach": 0, "clear": 0}
    for r in featured.collect():
        assert r.obs[1:4] == [float(r.derived_aspect == a) for a in aspects]
        assert r.obs[4] == min(r.n_ahead, 2) / 2
        aspects[r.derived_aspect] += 1
    assert all(aspects.values())


def test_parity_sees_missing_and_different_rows(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "id int, s double")
    b = spark.createDataFrame([(1, 1.0), (2, 2.1)], "id int, s double")
    assert tuple(scoring.score_parity(a, b, ["id"], "s").first()) == (3, 2, False)


def reward(spark, adherence, speed, previous, signal):
    cols = (F.lit(adherence), F.lit(speed), F.lit(previous), F.lit(signal))
    return spark.range(1).select(step_reward(*cols)).first()[0]


def test_reward(spark):
    assert reward(spark, 0.0, 40.0, 79.0, "approach") == pytest.approx(-0.3 * 39 / 79)
    assert reward(spark, -900.0, 0.0, 0.0, "stop") == -2.0
    assert reward(spark, 0.0, 79.0, 79.0, "clear") == pytest.approx(0.1)


@pytest.mark.parametrize("seconds", [60, 3600, 10**9])
def test_bucket_numbering_equals_plain_window(spark, layers, seconds):
    """One train holds a third of the rows, some rows have no train; no small partitions merged."""
    hot = layers.silver.withColumn(
        "train_id",
        F.when(F.xxhash64("event_id") % 3 == 0, "T_HOT")
        .when(F.xxhash64("event_id") % 7 == 0, None)
        .otherwise(F.col("train_id")),
    ).select("train_id", "event_time", "event_id", "current_speed_mph", "schedule_adherence_sec")
    carry = ["current_speed_mph", "schedule_adherence_sec"]
    w = Window.partitionBy("train_id").orderBy("event_time", "event_id")
    plain = hot.withColumns(
        {"row_no": F.row_number().over(w).cast("bigint")}
        | {f"prev_{c}": F.lag(c).over(w) for c in carry}
    )
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        got = number_rows(
            hot, ["train_id"], ["event_time", "event_id"], carry, time_bucket("event_time", seconds)
        )
        assert rows(got) == rows(plain)
    finally:
        spark.conf.set(merging, "true")


@pytest.mark.parametrize("user", [0, 999, 9999, 99999])
def test_ids_are_never_cut(spark, tmp_path, user):
    n = 10**12
    events = spark.createDataFrame([(n + 1, user, "click", 5.0)], EVENTS)
    events.write.parquet(str(tmp_path / "events.parquet"))
    row = train_events(spark, str(tmp_path), fleet=True).first()
    assert row.train_id == f"T_{user + 1:04d}" and row.event_id == f"E_{n + 1:012d}"


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0], [3.0, 3.0], list(np.linspace(0, 1, 41))])
def test_histogram_equals_numpy(spark, values):
    data = pd.DataFrame({"policy": "p", "train_id": "t", "episode_no": range(len(values)), "m": values})
    got = ev.histogram(spark.createDataFrame(data), metrics=["m"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in got] == list(counts)
    assert [r.bin_low for r in got] == pytest.approx(list(edges[:-1]))
    assert got[-1].bin_high == edges[-1] and got[0]["mean"] == pytest.approx(np.mean(values))


def test_short_episodes_are_left_out(layers):
    cfg = CorridorConfig(episode_steps=100)
    steps = ev.with_episodes(ev.step_rewards(layers.silver, cfg), cfg)
    assert steps.agg(F.max("episode_step")).first()[0] == 100
    full = ev.episode_metrics(steps, cfg).count()
    assert full == sum(r["count"] // 100 for r in layers.silver.groupBy("train_id").count().collect())


def test_rewards_scan_and_shuffle_the_events_once(layers):
    """The final plan after running: one scan, one shuffle of events, read twice."""
    fresh = Layers(layers.spark, layers.sf_dir)
    steps = ev.with_episodes(ev.step_rewards(fresh.silver))
    metrics = ev.policy_metrics(fresh.episodes)
    for df in (steps, fresh.episodes, ev.compare_policies(metrics, "base")):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("from_json") == 1 and final.count("FileScan") == 1
        assert "ReusedExchange" in final


def test_an_absent_base_policy_is_an_error(spark):
    rows_ = [("a", 1, 2.0, None), ("b", 2, 3.0, 4.0)]
    metrics = spark.createDataFrame(
        rows_, "policy string, n_episodes bigint, mean_reward double, mean_adherence_sec double"
    )
    with pytest.raises(PySparkException, match="no figures of the base policy 'c'"):
        ev.compare_policies(metrics, "c").collect()
    assert [tuple(r) for r in ev.compare_policies(metrics, "a").collect()] == [("b", 2, 1.0, None)]
    assert ev.compare_policies(metrics.limit(0), "a").count() == 0
    assert ev.compare_policies(metrics.where("policy = 'a'"), "a").count() == 0


def test_histogram_leaves_out_what_is_no_finite_number(spark):
    values = [1.0, 2.0, 5.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([("p", v) for v in values] + [("q", float("nan"))], "policy string, m double")
    got = ev.histogram(df, metrics=["m"]).orderBy("policy", "bin").collect()
    assert len(got) == 40
    p = [r for r in got if r.policy == "p"]
    assert sum(r.n for r in p) == 3 and (p[0].bin_low, p[-1].bin_high) == (1.0, 5.0)
    assert p[0]["mean"] == pytest.approx(8 / 3)
    assert all((r.n, r.bin_low, r.bin_high, r["mean"]) == (0, None, None, None) for r in got if r.policy == "q")
