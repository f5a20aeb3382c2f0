"""Late data, restart and batch equality of the streaming jobs."""

import datetime
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from conftest import SF, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.operators.events import parse_events, validate_events
from corridor.operators.ordering import number_rows
from corridor.operators.scoring import score_policy, with_features
from corridor.plans.layers import Layers, example_network
from corridor.schema import GOLD, OCCUPANCY
from corridor.session import new_path
from corridor.sources import deliveries, log, tables
from corridor.sources.folders import Folder
from corridor.streaming import jobs, sinks
from corridor.streaming.late import LateRows
from corridor.streaming.ordered import AT, InOrder, number_stream


def silver_stream(spark, path):
    raw = log.read_event_stream(
        spark, "parquet", path, maxFilesPerTrigger="1", recursiveFileLookup="true"
    )
    return validate_events(parse_events(raw))


@pytest.fixture(scope="module")
def late_feed(spark):
    jobs.prepare_state(spark)
    path = new_path(spark, "late")
    deliveries.write_deliveries(Layers(spark, SF).log.coalesce(1), path, 500, late_period=97)
    return path


def test_late_rows_are_dropped_in_append(spark, layers, late_feed):
    out = new_path(spark, "append")
    with LateRows(spark, f"{out}/late") as late:
        query = jobs.start_occupancy(
            silver_stream(spark, late_feed), f"{out}/t", f"{out}/c", "append"
        )
        jobs.finish([query])
        assert late.count(query) > 0
    got = tables.read_table(spark, f"{out}/t", schema=OCCUPANCY)
    assert got.count() < layers.occupancy.count()


def test_late_rows_are_kept_in_complete(spark, layers, late_feed):
    out = new_path(spark, "complete")
    with LateRows(spark, f"{out}/late") as late:
        query = jobs.start_occupancy(
            silver_stream(spark, late_feed), f"{out}/t", f"{out}/c", "complete"
        )
        jobs.finish([query])
        assert late.count(query) == 0
    assert rows(sinks.read_complete(spark, f"{out}/t")) == rows(layers.occupancy)


def report(query_id, batch, *dropped):
    """What Spark reports of one batch, as far as the counter looks at it."""
    states = [SimpleNamespace(numRowsDroppedByWatermark=n) for n in dropped]
    return SimpleNamespace(
        progress=SimpleNamespace(id=query_id, batchId=batch, stateOperators=states)
    )


def test_late_rows_are_summed_over_many_batches_and_a_restart(spark):
    """150 batches, more than a query remembers; repeated reports count once."""
    path = new_path(spark, "late")
    query = SimpleNamespace(id="a-query", lastProgress={"batchId": 149})
    late = LateRows(spark, path)
    for batch in range(100):
        late.onQueryProgress(report("a-query", batch, batch % 3, 1))
        late.onQueryProgress(report("other", batch, 1000))
    # Another listener goes on from what the first has stored.
    late = LateRows(spark, path)
    for batch in range(98, 150):
        late.onQueryProgress(report("a-query", batch, batch % 3, 1))
    late.onQueryProgress(report("a-query", 149, 5))
    assert late.count(query) == sum(batch % 3 + 1 for batch in range(150))
    assert len(Folder(spark, f"{path}/a-query").names()) == 1
    with pytest.raises(TimeoutError):
        late.count(SimpleNamespace(id="a-query", lastProgress={"batchId": 150}), wait_sec=0.2)


def test_late_rows_of_a_stream_with_a_restart(spark):
    """Every second batch brings one event of a window closed long ago."""
    jobs.prepare_state(spark, 2)
    out = new_path(spark, "count")
    start = datetime.datetime(2024, 1, 1)

    def add(i: int) -> None:
        times = [start + datetime.timedelta(minutes=10 * i)] + [start] * (i % 2 and i > 2)
        events = [(f"T{i}", f"E{i}-{j}", t) for j, t in enumerate(times)]
        df = spark.createDataFrame(events, "train_id string, event_id string, event_time timestamp")
        df.coalesce(1).write.mode("append").parquet(f"{out}/in")

    def run() -> int:
        stream = (
            spark.readStream.schema("train_id string, event_id string, event_time timestamp")
            .option("maxFilesPerTrigger", "1")
            .parquet(f"{out}/in")
            .withWatermark("event_time", "30 seconds")
        )
        windows = stream.groupBy(F.window("event_time", "30 seconds"), "train_id").count()
        query = sinks.write_append(windows, f"{out}/t", f"{out}/c")
        jobs.finish([query])
        return late.count(query)

    for first, last in ((0, 8), (8, 14)):
        for i in range(first, last):
            add(i)
        with LateRows(spark, f"{out}/late") as late:
            assert run() == len([i for i in range(last) if i % 2 and i > 2])


def ordered_feed(spark, path, events, per_file):
    schema = "train_id string, event_time timestamp, event_id string, speed double"
    for at in range(0, len(events), per_file):
        df = spark.createDataFrame(events[at : at + per_file], schema)
        df.coalesce(1).write.mode("append").parquet(path)
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", "1")
        .parquet(path)
        .withWatermark("event_time", "30 seconds")
    )


def test_rows_are_numbered_in_event_time_on_a_stream(spark):
    """Rows swapped within the watermark, ties and null values; equal to the batch numbers."""
    jobs.prepare_state(spark, 2)
    out, rng = new_path(spark, "ordered"), random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    events = [
        (f"T{rng.randint(1, 3)}", start + datetime.timedelta(seconds=i // 2), f"E{i:04d}", rng.choice([None, i / 2]))
        for i in range(240)
    ]
    shuffled = sorted(events, key=lambda e: e[1] + datetime.timedelta(seconds=rng.random() * 10))
    stream = ordered_feed(spark, f"{out}/in", shuffled, 40)
    order = ["event_time", "event_id"]
    numbered = number_stream(stream, ["train_id"], order, ["speed", "event_id"])
    jobs.finish([sinks.write_append(numbered, f"{out}/t", f"{out}/c")])
    df = spark.createDataFrame(events, "train_id string, event_time timestamp, event_id string, speed double")
    passed = max(e[1] for e in events) - datetime.timedelta(seconds=30)
    want = number_rows(df, ["train_id"], order, ["speed", "event_id"]).where(F.col("event_time") <= F.lit(passed))
    got = tables.read_table(spark, f"{out}/t")
    assert got.columns == want.columns
    assert rows(got) == rows(want) and want.count() > 100

    # The state goes on after a restart.
    more = [
        (t, at + datetime.timedelta(seconds=200), f"{name}-again", speed) for t, at, name, speed in events
    ]
    stream = ordered_feed(spark, f"{out}/in", more, 120)
    numbered = number_stream(stream, ["train_id"], order, ["speed", "event_id"])
    jobs.finish([sinks.write_append(numbered, f"{out}/t", f"{out}/c")])
    df = df.union(spark.createDataFrame(more, df.schema))
    passed += datetime.timedelta(seconds=200)
    want = number_rows(df, ["train_id"], order, ["speed", "event_id"]).where(F.col("event_time") <= F.lit(passed))
    assert rows(tables.read_table(spark, f"{out}/t")) == rows(want)


class Held:
    """List, value and timers of a key, kept here."""

    def __init__(self):
        self.rows, self.value, self.timers = [], None, []

    def getListState(self, name, schema):
        return SimpleNamespace(
            appendValue=self.rows.append, appendList=self.rows.extend,
            get=lambda: iter(list(self.rows)), clear=self.rows.clear,
            put=lambda new: self.rows.__setitem__(slice(None), new),
        )

    def getValueState(self, name, schema):
        return SimpleNamespace(
            exists=lambda: self.value is not None, get=lambda: self.value,
            update=lambda new: setattr(self, "value", new),
        )

    def listTimers(self):
        return iter(list(self.timers))

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_rows_wait_in_batches_not_one_by_one():
    waiting = T.StructType(
        [T.StructField(AT, T.LongType()), T.StructField("name", T.StringType()), T.StructField("speed", T.DoubleType())]
    )
    held, n = Held(), 120_000
    order = InOrder(["train", *waiting.names], ["train"], ["name"], ["speed", "name"], waiting)
    order.init(held)
    rng = np.random.default_rng(2)
    at = rng.permutation(n) // 2 * 1000
    parts = [
        pd.DataFrame({"train": "t", AT: at[i : i + 10_000], "name": None if not i else [f"é{x}" for x in range(i, i + 10_000)],
                      "speed": np.where(np.arange(10_000) % 9 == 0, np.nan, np.arange(10_000.0))})
        for i in range(0, n, 10_000)
    ]
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    assert not list(order.handleInputRows(("t",), iter(parts), now))
    assert len(held.rows) <= len(parts) and len(held.timers) == 1
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: n // 2 - 101)
    first = list(order.handleExpiredTimer(("t",), now, None))
    assert len(first) > 1 and sum(map(len, first)) == n - 200
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: n)
    rest = list(order.handleExpiredTimer(("t",), now, None))
    assert not held.rows and not list(order.handleInputRows(("t",), iter(()), now))
    got = pd.concat(first + rest, ignore_index=True)
    want = pd.concat(parts).sort_values([AT, "name"], kind="stable", ignore_index=True)
    assert got["row_no"].tolist() == list(range(1, n + 1)) and (got["train"] == "t").all()
    for c in waiting.names:
        assert got[c].astype(object).where(got[c].notna(), None).tolist() == want[c].astype(object).where(want[c].notna(), None).tolist()
    for c in ("speed", "name"):
        before = got[f"prev_{c}"].astype(object).where(got[f"prev_{c}"].notna(), None)
        assert before.tolist() == [None, *want[c].astype(object).where(want[c].notna(), None)][:-1]


def test_restart_loses_and_repeats_nothing(spark, layers):
    jobs.prepare_state(spark)
    out = new_path(spark, "restart")
    numbered = Layers(spark, SF).log.coalesce(1)
    deliveries.write_deliveries(numbered.where("n < 5000"), f"{out}/log/a", 1000)
    stream = silver_stream(spark, f"{out}/log")
    for mode in ("append", "update"):
        jobs.finish([jobs.start_occupancy(stream, f"{out}/{mode}", f"{out}/c_{mode}", mode)])
    deliveries.write_deliveries(numbered.where("n >= 5000"), f"{out}/log/b", 1000)
    stream = silver_stream(spark, f"{out}/log")
    for mode in ("append", "update"):
        jobs.finish([jobs.start_occupancy(stream, f"{out}/{mode}", f"{out}/c_{mode}", mode)])
    newest = layers.silver.agg(F.max("event_time")).first()[0]
    closed = layers.occupancy.where(
        F.col("window_end") <= F.lit(newest) - F.expr("interval 30 seconds")
    )
    assert rows(tables.read_table(spark, f"{out}/append", schema=OCCUPANCY)) == rows(closed)
    keys = ["window_start", "window_end", "train_id"]
    assert rows(sinks.read_upserted(spark, f"{out}/update", keys)) == rows(layers.occupancy)


def test_log_keeps_keys_together(spark):
    df = spark.range(100).selectExpr("cast(id % 5 as string) k", "id")
    parts = log.repartition_by_key(df, "k", 4, ["id"]).withColumn("p", F.spark_partition_id())
    assert parts.groupBy("k").agg(F.count_distinct("p").alias("n")).where("n > 1").isEmpty()


def test_events_can_be_published_to_files(spark, layers):
    path = new_path(spark, "published")
    log.write_events(layers.silver.drop("event_time"), "parquet", path)
    again = parse_events(tables.read_table(spark, path))
    assert again.count() == layers.silver.count()
    assert again.exceptAll(layers.silver.drop("event_time")).isEmpty()


def test_log_defaults(monkeypatch):
    monkeypatch.setenv(log.BROKER_VARIABLE, "a:1")
    options = log.log_options()
    assert options["kafka.bootstrap.servers"] == "a:1"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("latest", "false")


def test_scored_stream_equals_batch(spark, layers):
    out = new_path(spark, "scored")
    tables.write_table(layers.gold, f"{out}/gold")
    stream = tables.read_table_stream(spark, f"{out}/gold", GOLD)
    jobs.finish([jobs.start_scored(stream, example_network(), f"{out}/t", f"{out}/c")])
    batch = score_policy(with_features(layers.gold), example_network()).drop("obs")
    got = sinks.read_batches(spark, f"{out}/t")
    assert rows(got.drop("stored_batch")) == rows(batch)
    assert got.select("stored_batch").distinct().count() >= 1


def test_state_settings_are_put_back(spark):
    names = [*jobs.STATE_SETTINGS, "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n, None) for n in names]
    with jobs.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert [spark.conf.get(n, None) for n in names] == before
