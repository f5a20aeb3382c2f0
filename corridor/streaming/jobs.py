"""The streaming jobs: log -> Bronze -> Silver and occupancy -> Gold."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corridor.config import DEFAULT, CorridorConfig
from corridor.operators import scoring
from corridor.operators.advisories import with_advisories
from corridor.operators.evaluation import rewarded, step_columns
from corridor.operators.events import parse_events, validate_events
from corridor.operators.occupancy import latest_states, merged_states, occupancy, state_columns
from corridor.streaming import sinks
from corridor.streaming.ordered import number_stream
from corridor.streaming.sinks import AVAILABLE_NOW, Trigger
from corridor.streaming.versions import STORED_BATCH, Run, Version, Versions

# Folders of the two tables that one query writes.
SILVER, OCCUPANCY = "silver", "occupancy"

# Keeps window state off the JVM heap and uploads only what a batch changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare_state(spark: SparkSession, partitions: int | None = None) -> None:
    """Choose the state store before a stateful query first starts.

    The number of state partitions is fixed by the first checkpoint: give the
    number the job is to keep.
    """
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


@contextmanager
def state_settings(spark: SparkSession, partitions: int) -> Iterator[None]:
    """``prepare_state`` for the queries started inside; the session's own values return."""
    names = [*STATE_SETTINGS, "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name, None) for name in names}
    prepare_state(spark, partitions)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_bronze(
    raw: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger=AVAILABLE_NOW
) -> StreamingQuery:
    """Append parsed log rows."""
    return sinks.write_append(parse_events(raw), path, checkpoint, fmt, trigger)


def start_occupancy(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Windowed train state.

    ``append`` emits a window once it is closed and is the mode for long runs.
    ``update`` stores changed rows. ``complete`` rewrites the whole result and
    keeps state for ever, so its use is limited to short runs.
    """
    rows = occupancy(silver, cfg)
    if mode == "update":
        return sinks.write_update(rows, path, checkpoint, occupancy_keys(cfg), fmt, trigger)
    write = {"append": sinks.write_append, "complete": sinks.write_complete}[mode]
    return write(rows, path, checkpoint, fmt, trigger)


def occupancy_keys(cfg: CorridorConfig = DEFAULT) -> list[str]:
    return ["window_start", "window_end", *cfg.keys]


def start_silver(
    bronze: DataFrame,
    silver_path: str,
    occupancy_path: str,
    checkpoint: str,
    mode: str = "append",
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two sinks from one validated stream: the events and their occupancy."""
    silver = validate_events(bronze, cfg)
    return (
        sinks.write_append(silver, silver_path, f"{checkpoint}/silver", fmt, trigger),
        start_occupancy(
            silver, occupancy_path, f"{checkpoint}/occupancy", mode, cfg, fmt, trigger
        ),
    )


def start_silver_and_occupancy(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Both tables from one query, which reads and parses its source once.

    Each batch stores its events, computes the newest state per window and train from
    those stored rows, and commits both under the number of the batch: readers see the
    two tables change together, and a repeated batch changes neither. States are maxima,
    so runs of several batches merge into the result of one aggregate over all events;
    late events count, and no state is kept between batches.
    """
    return (
        validate_events(bronze, cfg)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(store_silver_and_occupancy(path, cfg, fmt))
        .start()
    )


def store_silver_and_occupancy(
    path: str, cfg: CorridorConfig = DEFAULT, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """What ``start_silver_and_occupancy`` does with each batch of validated events."""

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path, fmt)
        newest = versions.newest()
        if newest.batch_id >= batch_id:
            return
        stored = versions.append(SILVER, batch_id, batch)
        run = versions.write(OCCUPANCY, Run(batch_id, batch_id), latest_states(stored, cfg))
        runs = versions.add(
            OCCUPANCY, newest.of(OCCUPANCY), run, lambda states: merged_states(states, cfg)
        )
        versions.commit(Version(batch_id, {OCCUPANCY: runs}))

    return write


def read_silver_and_occupancy(
    spark: SparkSession, path: str, cfg: CorridorConfig = DEFAULT, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Both tables as of one committed batch."""
    versions = Versions(spark, path, fmt)
    silver = versions.read_appended(SILVER).drop(STORED_BATCH)
    states = versions.read(OCCUPANCY, versions.newest().of(OCCUPANCY))
    return silver, state_columns(merged_states(states, cfg), cfg)


def start_gold(
    occupancy_stream: DataFrame,
    path: str,
    checkpoint: str,
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append advisory rows for closed windows."""
    return sinks.write_append(
        with_advisories(occupancy_stream, cfg), path, checkpoint, fmt, trigger
    )


def start_step_rewards(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append step number, previous speed and reward of every event the watermark passed."""
    order = ["event_time", "event_id"]
    numbered = number_stream(step_columns(silver, cfg), cfg.keys, order, ["current_speed_mph"])
    return sinks.write_append(rewarded(numbered, cfg), path, checkpoint, fmt, trigger)


def start_scored(
    gold_stream: DataFrame,
    layers: tuple[scoring.Layer, ...],
    path: str,
    checkpoint: str,
    cfg: CorridorConfig = DEFAULT,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
    activation: str = "relu",
) -> StreamingQuery:
    """Publish Gold rows with the network's advice as one more column.

    Every row is stored under the number of its batch; ``sinks.read_batches`` reads them.
    """
    scored = scoring.score_policy(scoring.with_features(gold_stream, cfg), layers, activation)
    return sinks.write_batches(scored.drop("obs"), path, checkpoint, fmt, trigger)


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


def run_until_stopped(
    queries: Sequence[StreamingQuery],
    stop: threading.Event,
    poll_sec: float = 1.0,
    grace_sec: float = 60.0,
) -> None:
    """Wait until ``stop`` is set, every query has ended, or one has failed.

    A failure ends all queries and is raised. On ``stop`` each query may end the batch it
    is working on; after ``grace_sec`` it is stopped as it is, and its checkpoint repeats
    that batch at the next start.
    """
    try:
        while not stop.wait(poll_sec):
            for query in queries:
                if query.exception() is not None:
                    raise query.exception()
            if not any(query.isActive for query in queries):
                return
    finally:
        deadline = time.monotonic() + (grace_sec if stop.is_set() else 0)
        for query in queries:
            while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
                time.sleep(0.05)
            query.stop()
