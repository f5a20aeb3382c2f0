"""Sinks for the three output modes on plain files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corridor.streaming.versions import FAN_IN, RETAIN, Run, Version, Versions

Trigger = dict[str, object]
AVAILABLE_NOW: Trigger = {"availableNow": True}
#: Name of a sink's only table, and the column with the batch that changed a row.
RESULT = "result"
BATCH = "changed_in_batch"


def write_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append every finished row once; restarts continue from ``checkpoint``."""
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def _start_batches(df, mode, checkpoint, trigger, write) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append rows under the number of their batch; read them with ``read_batches``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path, fmt)
        if versions.newest().batch_id < batch_id:
            versions.append(RESULT, batch_id, batch)
            versions.commit(Version(batch_id))

    return _start_batches(df, "append", checkpoint, trigger, write)


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of all committed batches of ``write_batches``, with ``stored_batch``."""
    return Versions(spark, path, fmt).read_appended(RESULT)


def write_complete(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
    retain: int = RETAIN,
) -> StreamingQuery:
    """Replace the whole result at every trigger; read it with ``read_complete``.

    Every trigger writes a folder of its own. A reader's folder stays until ``retain``
    later results have been committed, so a slow reader ends what it began; older ones
    and their manifests are removed. A repeated batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path, fmt, retain)
        if versions.newest().batch_id < batch_id:
            run = versions.write(RESULT, Run(batch_id, batch_id), batch)
            versions.commit(Version(batch_id, {RESULT: [run]}))

    return _start_batches(df, "complete", checkpoint, trigger, write)


def read_complete(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest finished result of ``write_complete``."""
    versions = Versions(spark, path, fmt)
    return versions.read(RESULT, _runs(versions))


def _runs(versions: Versions) -> list[Run]:
    runs = versions.newest().of(RESULT)
    if not runs:
        raise FileNotFoundError(f"no batch has been committed below {versions.path}")
    return runs


def newest_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of every key; changes carry the number of their batch."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), BATCH).alias("_row")
    return changes.groupBy(*keys).agg(last).select(*keys, "_row.*")


def write_update(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
    fan_in: int = FAN_IN,
    retain: int = RETAIN,
) -> StreamingQuery:
    """Store only the rows each trigger changed; read them with ``read_upserted``.

    Every trigger adds one run of changes. ``fan_in`` runs of a level are merged into one
    of the next, keeping the last change of every key, so a reader merges few runs after
    any number of batches and no trigger but the merging ones touches older rows. A
    repeated batch changes nothing.
    """
    return _start_batches(df, "update", checkpoint, trigger, upsert(path, keys, fmt, fan_in, retain))


def upsert(
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    fan_in: int = FAN_IN,
    retain: int = RETAIN,
) -> Callable[[DataFrame, int], None]:
    """What ``write_update`` does with each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path, fmt, retain)
        newest = versions.newest()
        if newest.batch_id >= batch_id:
            return
        run = versions.write(
            RESULT, Run(batch_id, batch_id), batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        )
        runs = versions.add(
            RESULT, newest.of(RESULT), run, lambda rows: newest_changes(rows, keys), fan_in
        )
        versions.commit(Version(batch_id, {RESULT: runs}))

    return write


def read_upserted(
    spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """The latest version of every row of ``write_update``."""
    versions = Versions(spark, path, fmt)
    return newest_changes(versions.read(RESULT, _runs(versions)), keys).drop(BATCH)
