"""The keyed event log: Kafka, or any table with the Kafka row shape."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.config import TOPIC
from corridor.schema import LOG_ROW
from corridor.sources import keyed_log

# Environment variable and address of the default broker.
BROKER_VARIABLE = "KAFKA_BROKER"
DEFAULT_BROKER = "localhost:9092"


def broker() -> str:
    return os.environ.get(BROKER_VARIABLE, DEFAULT_BROKER)


def log_options(topic: str = TOPIC) -> dict[str, str]:
    """Kafka source options: new events only, and gaps in the log are tolerated."""
    return {
        "kafka.bootstrap.servers": broker(),
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Stream of keyed rows, from new rows on unless ``startingOffsets`` says otherwise.

    ``kafka`` needs the connector jar. ``keyed_log`` is the log in a folder below ``path``;
    any file format with the same row shape can stand in for either.
    """
    if fmt == "kafka":
        return spark.readStream.format(fmt).options(**(log_options() | options)).load()
    if fmt == keyed_log.FORMAT:
        keyed_log.register(spark)
        policy = {k: v for k, v in log_options().items() if k in ("startingOffsets", "failOnDataLoss")}
        return spark.readStream.format(fmt).options(path=path, **(policy | options)).load()
    return spark.readStream.schema(LOG_ROW).format(fmt).options(**options).load(path)


def to_keyed_json(df: DataFrame, key: str = "train_id") -> DataFrame:
    """Rows as ``(key, value)`` bytes, the value being the JSON of the whole row."""
    return df.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


def write_events(
    df: DataFrame, fmt: str = "kafka", path: str | None = None, key: str = "train_id"
) -> None:
    """Publish rows to the log. Equal keys go to one partition of the topic."""
    keyed = to_keyed_json(df, key)
    if fmt == "kafka":
        options = {"kafka.bootstrap.servers": broker(), "topic": TOPIC}
        keyed.write.format(fmt).options(**options).save()
    else:
        keyed.write.format(fmt).mode("append").save(path)


def repartition_by_key(df: DataFrame, key: str, n: int, order: list[str]) -> DataFrame:
    """All rows of a key in one of ``n`` partitions, in ``order``: the log's guarantee.

    A very frequent key makes its partition large. Use it only to feed a log that
    needs the order; the operators do not.
    """
    return df.repartition(n, key).sortWithinPartitions(*order)
