"""The keyed log: offsets, order, resume, lost offsets, unfinished and competing appends."""

import datetime
import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corridor.session import new_path
from corridor.sources import keyed_log, log
from corridor.sources.folders import Folder
from corridor.streaming import jobs, sinks

START = datetime.datetime(2024, 1, 1)


def events(spark, first, n, hot=0.4):
    """Rows numbered from ``first``; key k0 has many of them, some have no key."""
    keys = F.when(F.rand(3) < hot, "k0").when(F.col("n") % 17 == 0, None).otherwise(
        F.concat(F.lit("k"), (F.col("n") % 9).cast("string"))
    )
    return spark.range(first, first + n).select(
        F.col("id").alias("n"),
    ).select(
        keys.cast("binary").alias("key"),
        F.concat(F.lit("v"), F.col("n").cast("string")).cast("binary").alias("value"),
        F.timestamp_seconds(F.lit(int(START.timestamp())) + (F.col("n") * 37).cast("int")).alias("timestamp"),
        "n",
    )


def append(spark, path, first, n):
    # Random keys are drawn once.
    kept = new_path(spark, "events")
    events(spark, first, n).write.parquet(kept)
    return keyed_log.append_events(spark.read.parquet(kept), path, ["timestamp", "n"], partitions=3)


def read(spark, path, **options):
    keyed_log.register(spark)
    return spark.read.format(keyed_log.FORMAT).options(path=path, **options).load()


def run(spark, path, out, **options):
    raw = log.read_event_stream(spark, keyed_log.FORMAT, path, **options)
    jobs.finish([sinks.write_append(raw, f"{out}/t", f"{out}/c")])
    return spark.read.schema(raw.schema).parquet(f"{out}/t")


def values(df):
    return sorted(bytes(r.value).decode() for r in df.select("value").collect())


def test_offsets_have_no_gaps_and_follow_the_order(spark):
    path = new_path(spark, "log")
    append(spark, path, 0, 500)
    commit = append(spark, path, 500, 300)
    got = read(spark, path).toPandas()
    assert len(got) == 800 and sum(commit.end.values()) == 800
    for p, part in got.groupby("partition"):
        part = part.sort_values("offset")
        assert list(part["offset"]) == list(range(commit.end[str(p)]))
        assert part["timestamp"].is_monotonic_increasing
    assert got.groupby("key", dropna=False)["partition"].nunique().max() == 1
    assert set(got["topic"]) == {"train_events"}


def test_a_table_between_two_offsets(spark):
    path = new_path(spark, "log")
    append(spark, path, 0, 200)
    commit = append(spark, path, 200, 200)
    some = {p: n - 5 for p, n in commit.end.items()}
    got = read(spark, path, startingOffsets=json.dumps(some))
    assert got.count() == 15
    got = read(spark, path, startingOffsets=json.dumps({"0": commit.end["0"] - 1}), endingOffsets=json.dumps(commit.end))
    assert got.where("partition = 0").count() == 1 and got.where("partition > 0").count() > 50
    assert read(spark, path, startingOffsets="latest").count() == 0


def test_an_unfinished_append_is_not_seen(spark):
    path = new_path(spark, "log")
    append(spark, path, 0, 50)
    # What an append leaves that stops before its commit.
    read(spark, path).drop("topic").write.partitionBy("partition").parquet(f"{path}/commit=1-stopped")
    assert read(spark, path).count() == 50
    append(spark, path, 50, 10)
    assert read(spark, path).count() == 60


def test_of_two_appends_at_a_time_one_fails(spark, monkeypatch):
    path = new_path(spark, "log")
    append(spark, path, 0, 30)
    newest = keyed_log._newest
    monkeypatch.setattr(keyed_log, "_newest", lambda commits: stale)
    stale = newest(Folder(spark, f"{path}/{keyed_log.COMMITS}"))
    append(spark, path, 30, 5)
    with pytest.raises(RuntimeError, match="came first"):
        append(spark, path, 100, 5)
    assert values(read(spark, path)) == sorted(f"v{n}" for n in range(35))


def test_an_empty_append_and_an_empty_log(spark):
    path = new_path(spark, "log")
    commit = append(spark, path, 0, 0)
    assert set(commit.end.values()) == {0} and read(spark, path).count() == 0
    append(spark, path, 0, 4)
    assert read(spark, path).count() == 4
    assert read(spark, new_path(spark, "nothing")).count() == 0


def test_a_stream_goes_on_where_it_stopped(spark):
    path, out = new_path(spark, "log"), new_path(spark, "out")
    append(spark, path, 0, 120)
    assert values(run(spark, path, out, startingOffsets="earliest")) == sorted(f"v{n}" for n in range(120))
    append(spark, path, 120, 80)
    append(spark, path, 200, 40)
    # The starting option no longer counts.
    assert values(run(spark, path, out, startingOffsets="latest")) == sorted(f"v{n}" for n in range(240))
    assert run(spark, path, out).count() == 240


def test_a_stream_starts_at_new_rows_by_default(spark):
    path, out = new_path(spark, "log"), new_path(spark, "out")
    append(spark, path, 0, 60)
    assert run(spark, path, out).count() == 0
    append(spark, path, 60, 20)
    assert values(run(spark, path, out)) == sorted(f"v{n}" for n in range(60, 80))


def test_a_stream_starts_at_given_offsets(spark):
    path, out = new_path(spark, "log"), new_path(spark, "out")
    commit = append(spark, path, 0, 90)
    start = {p: n - 3 for p, n in commit.end.items()}
    assert run(spark, path, out, startingOffsets=json.dumps(start)).count() == 9


def test_lost_offsets_are_an_error_or_are_passed_over(spark):
    path, strict, tolerant = (new_path(spark, n) for n in ("log", "strict", "tolerant"))
    append(spark, path, 0, 50)
    for out in (strict, tolerant):
        run(spark, path, out, startingOffsets="earliest")
    append(spark, path, 50, 50)
    append(spark, path, 100, 50)
    keyed_log.expire(spark, path, keep=1)
    with pytest.raises(PySparkException, match="are gone"):
        run(spark, path, strict, failOnDataLoss="true")
    got = run(spark, path, tolerant)
    assert values(got) == sorted(f"v{n}" for n in [*range(50), *range(100, 150)])


def test_rows_per_trigger_share_out_what_is_new():
    class Fixed(keyed_log._Log):
        def ends(self):
            return {"0": 10, "1": 100}

        def earliest(self):
            return {"0": 0, "1": 0}

    reader = keyed_log._StreamReader(Fixed({"path": "/x", "maxRowsPerTrigger": "40", "startingOffsets": "earliest"}))
    seen = [reader.initialOffset()] + [reader.latestOffset() for _ in range(6)]
    assert seen[1] == {"0": 10, "1": 20} and seen[2] == {"0": 10, "1": 40}
    assert seen[5] == seen[6] == {"0": 10, "1": 100}
