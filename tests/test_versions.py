"""Tables that streams change: slow readers, compaction, repeated and failed batches."""

import random

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from corridor.operators.events import parse_events
from corridor.operators.occupancy import occupancy
from corridor.plans.layers import Layers
from corridor.schema import SILVER_EVENT
from corridor.session import new_path
from corridor.sources import log
from corridor.sources.folders import Folder
from corridor.streaming import jobs, sinks
from corridor.streaming.versions import Run, Version, Versions, compaction


def test_few_runs_after_many_batches():
    runs, rewritten = [], 0
    for batch in range(2000):
        runs = [*runs, Run(batch, batch)]
        due = compaction(runs, 8)
        if due:
            taken, merged = due
            rewritten += merged.last - merged.first + 1
            runs = [*runs[: -len(taken)], merged]
        assert [r.first for r in runs[1:]] == [r.last + 1 for r in runs[:-1]]
        assert (runs[0].first, runs[-1].last) == (0, batch)
        assert len(runs) <= 7 * 4
    assert rewritten <= 2000 * 4


def test_versions_survive_as_text():
    version = Version(7, {"a": [Run(0, 5, 1), Run(6, 6)], "b": []})
    assert Version.parse(version.text()) == version


def test_folder_files_are_whole_and_final(spark):
    folder = Folder(spark, new_path(spark, "folder"))
    assert folder.names() == []
    folder.write("a", "first")
    folder.write("a", "second")
    assert (folder.names(), folder.read("a")) == (["a"], "first")
    folder.remove("a")
    assert folder.names() == []


def complete_writer(path, retain):
    def write(df, batch_id):
        versions = Versions(df.sparkSession, path, retain=retain)
        if versions.newest().batch_id < batch_id:
            run = versions.write(sinks.RESULT, Run(batch_id, batch_id), df)
            versions.commit(Version(batch_id, {sinks.RESULT: [run]}))

    return write


def test_a_slow_reader_of_complete_results_ends_what_it_began(spark):
    path = new_path(spark, "slow")
    write = complete_writer(path, retain=4)
    write(spark.range(10), 0)
    reader = sinks.read_complete(spark, path)
    for batch in range(1, 4):
        write(spark.range(batch), batch)
    assert reader.count() == 10
    assert sinks.read_complete(spark, path).count() == 3
    for batch in range(4, 12):
        write(spark.range(batch), batch)
    assert len(Folder(spark, f"{path}/manifests").names()) == 4
    assert len(Folder(spark, f"{path}/{sinks.RESULT}").names()) == 4


def test_reading_before_the_first_batch(spark):
    with pytest.raises(FileNotFoundError):
        sinks.read_complete(spark, new_path(spark, "none"))
    with pytest.raises(FileNotFoundError):
        sinks.read_upserted(spark, new_path(spark, "none"), ["k"])
    with pytest.raises(FileNotFoundError):
        jobs.read_silver_and_occupancy(spark, new_path(spark, "none"))


def test_many_update_batches_stay_cheap_to_read(spark):
    """Forty batches at a fan-in of three, some repeated, equal the last change of every key."""
    path = new_path(spark, "update")
    write = sinks.upsert(path, ["k", "part"], fan_in=3, retain=2)
    rng, want = random.Random(1), {}
    for batch in range(40):
        changed = {(rng.choice([None, *range(12)]), rng.randint(0, 1)): (batch, rng.choice([None, "x"])) for _ in range(5)}
        if batch == 20:
            changed = {}
        want |= changed
        df = spark.createDataFrame(
            [(*k, *v) for k, v in changed.items()], "k int, part int, n int, name string"
        ).coalesce(1)
        write(df, batch)
        if batch % 9 == 0:
            write(df.withColumn("n", F.lit(-1)), batch)
        if batch in (5, 26, 39):
            got = sinks.read_upserted(spark, path, ["k", "part"])
            assert rows(got.select("k", "part", "n", "name")) == sorted(
                ((*k, *v) for k, v in want.items()), key=repr
            )
    versions = Versions(spark, path, retain=2)
    assert len(versions.newest().of(sinks.RESULT)) <= 2 * 4
    assert len(Folder(spark, f"{path}/{sinks.RESULT}").names()) <= 2 * 2 * 4
    assert len(Folder(spark, f"{path}/manifests").names()) == 2


def test_a_failed_batch_leaves_nothing_visible(spark):
    path = new_path(spark, "failed")
    write = sinks.upsert(path, ["k"])
    write(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    # What a stop between the run and the manifest leaves behind.
    Versions(spark, path).write(
        sinks.RESULT, Run(1, 1), spark.createDataFrame([(1, "lost", 1)], f"k int, v string, {sinks.BATCH} bigint")
    )
    assert rows(sinks.read_upserted(spark, path, ["k"])) == [(1, "a")]
    write(spark.createDataFrame([(2, "b")], "k int, v string"), 1)
    assert rows(sinks.read_upserted(spark, path, ["k"])) == [(1, "a"), (2, "b")]


def test_keys_alone_can_be_upserted(spark):
    path = new_path(spark, "keys")
    write = sinks.upsert(path, ["id"], fan_in=2)
    for batch in range(5):
        write(spark.range(batch + 1), batch)
    assert rows(sinks.read_upserted(spark, path, ["id"])) == [(i,) for i in range(5)]


def test_complete_mode_continues_after_a_restart(spark, layers):
    jobs.prepare_state(spark)
    out = new_path(spark, "complete")
    numbered = Layers(spark, SF).log.coalesce(1)
    for name, part in (("a", "n < 4000"), ("b", "n >= 4000")):
        numbered.where(part).drop("n").write.parquet(f"{out}/log/{name}")
        stream = log.read_event_stream(spark, "parquet", f"{out}/log", recursiveFileLookup="true")
        silver = jobs.validate_events(parse_events(stream))
        jobs.finish([jobs.start_occupancy(silver, f"{out}/t", f"{out}/c", "complete")])
    assert rows(sinks.read_complete(spark, f"{out}/t")) == rows(layers.occupancy)


def test_two_tables_change_together(spark, layers):
    path = new_path(spark, "tables")
    write = jobs.store_silver_and_occupancy(path)
    silver = layers.silver.select(*SILVER_EVENT.fieldNames())
    number = F.pmod(F.hash("event_id"), F.lit(11))
    for batch in range(11):
        write(silver.where(number == batch), batch)
    events, states = jobs.read_silver_and_occupancy(spark, path)
    assert events.exceptAll(silver).isEmpty() and events.count() == silver.count()
    assert rows(states) == rows(layers.occupancy)

    # A repeated batch, with other rows, changes neither table.
    write(silver.limit(3), 10)
    again = jobs.read_silver_and_occupancy(spark, path)
    assert again[0].count() == silver.count()
    assert rows(again[1]) == rows(layers.occupancy)

    # Events that a batch stored before it failed are not seen, and are replaced later.
    extra = silver.limit(5).withColumns(
        {"event_time": F.expr("event_time + interval 1 day"), "event_id": F.concat(F.lit("x"), "event_id")}
    )
    silver.limit(7).write.parquet(f"{path}/{jobs.SILVER}/{jobs.STORED_BATCH}=11")
    assert jobs.read_silver_and_occupancy(spark, path)[0].count() == silver.count()
    write(extra, 11)
    events, states = jobs.read_silver_and_occupancy(spark, path)
    assert events.count() == silver.count() + 5
    assert rows(states) == rows(occupancy(silver.unionByName(extra)))
