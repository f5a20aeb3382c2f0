"""A keyed log in a folder: rows with offsets, read as a table or as a stream.

Every append is one commit: a folder of Parquet files for each log partition and a small
file with the first and the next offset of each partition. Rows of an unfinished append
are in no commit. Equal keys go to one partition, in the order given, and its offsets
have no gaps; a reader asks for offsets, so it goes on exactly where it stopped.

Options of the source: ``path``; ``startingOffsets`` (``earliest``, ``latest`` or a JSON
object of offsets by partition; a partition not named starts at its earliest) and, for a
table, ``endingOffsets``; ``failOnDataLoss`` (whether offsets that are asked for and no
longer there are an error, or are passed over); ``maxRowsPerTrigger`` for a stream.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from corridor.config import TOPIC
from corridor.operators.ordering import number_rows
from corridor.schema import LOG_ROW
from corridor.sources.folders import Folder

FORMAT = "keyed_log"
COMMITS = "commits"
ARROW_ROW = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
    ]
)

Offsets = dict[str, int]


@dataclass(frozen=True)
class Commit:
    """First and next offset of each partition that one append wrote."""

    number: int
    first: Offsets
    end: Offsets
    writer: str = ""

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @property
    def folder(self) -> str:
        # The writer's name keeps two appends at the same time apart.
        return f"commit={self.number}-{self.writer}"

    @staticmethod
    def file(number: int) -> str:
        return f"{number:020d}.json"


def _newest(commits: Folder) -> Commit | None:
    names = [n for n in commits.names() if n.endswith(".json")]
    return _commit(commits, names[-1]) if names else None


def _commit(commits: Folder, name: str) -> Commit:
    return Commit(**json.loads(commits.read(name)))


def append_events(
    events: DataFrame,
    path: str,
    order: Sequence[str],
    partitions: int = 4,
    topic: str = TOPIC,
    bucket: Column | None = None,
) -> Commit:
    """Append rows (``key``, ``value``, ``timestamp`` and the columns of ``order``) as one commit.

    Offsets follow ``order``, which tells any two rows of a partition apart; ``bucket`` is
    that of ``number_rows``. The number of partitions is that of the first append. Of two
    appends at the same time one fails and has no effect.
    """
    spark = events.sparkSession
    commits = Folder(spark, f"{path}/{COMMITS}")
    last = _newest(commits)
    first = dict(last.end) if last else {str(p): 0 for p in range(partitions)}
    commit = Commit(last.number + 1 if last else 0, first, {}, uuid.uuid4().hex)
    placed = events.withColumn("partition", F.pmod(F.hash("key"), F.lit(len(first))))
    before = F.element_at(
        F.create_map(*(F.lit(v) for p, n in first.items() for v in (int(p), n))), F.col("partition")
    )
    rows = number_rows(placed, ["partition"], order, bucket=bucket).select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        "partition",
        (F.col("row_no") - 1 + before).cast("bigint").alias("offset"),
        "timestamp",
    )
    folder = f"{path}/{commit.folder}"
    rows.sortWithinPartitions("partition", "offset").write.partitionBy("partition").parquet(folder)
    end = dict(first)
    if any(n.startswith("partition=") for n in Folder(spark, folder).names()):
        for r in spark.read.parquet(folder).groupBy("partition").agg(F.max("offset")).collect():
            end[str(r[0])] = r[1] + 1
    commit = Commit(commit.number, first, end, commit.writer)
    commits.write(Commit.file(commit.number), commit.text())
    if _commit(commits, Commit.file(commit.number)) != commit:
        raise RuntimeError(f"another append to {path} came first; nothing was written")
    return commit


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest ``keep`` commits; earlier offsets are then lost."""
    commits = Folder(spark, f"{path}/{COMMITS}")
    names = [n for n in commits.names() if n.endswith(".json")]
    for name in names[:-keep]:
        commit = _commit(commits, name)
        commits.remove(name)
        Folder(spark, path).remove(commit.folder)


def register(spark: SparkSession) -> None:
    """Make the source known to the session as ``keyed_log``."""
    spark.dataSource.register(KeyedLog)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


class FileRange(InputPartition):
    """Offsets from ``first`` to before ``end`` of one file."""

    def __init__(self, file: str, partition: int, first: int, end: int) -> None:
        super().__init__(file)
        self.file, self.partition, self.first, self.end = file, partition, first, end


class _Log:
    """Commits and files, as driver and tasks of the source see them."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"].rstrip("/")
        self.strict = options.get("failOnDataLoss", "true").lower() == "true"
        self.options = options

    def _names(self) -> tuple[fs.FileSystem, list[str]]:
        store, root = _file_system(f"{self.path}/{COMMITS}")
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return store, sorted(f.path for f in found if f.path.endswith(".json") and f.is_file)

    def _commit(self, store: fs.FileSystem, name: str) -> Commit:
        with store.open_input_file(name) as file:
            return Commit(**json.loads(file.read()))

    def ends(self) -> Offsets:
        store, names = self._names()
        return self._commit(store, names[-1]).end if names else {}

    def earliest(self) -> Offsets:
        store, names = self._names()
        return self._commit(store, names[0]).first if names else {}

    def named(self, option: str, default: str) -> Offsets:
        """Offsets as an option gives them."""
        value = self.options.get(option, default)
        if value == "latest":
            return self.ends()
        if value == "earliest":
            return self.earliest()
        return self.earliest() | {str(p): int(n) for p, n in json.loads(value).items()}

    def ranges(self, start: Offsets, end: Offsets) -> list[FileRange]:
        """The files that hold the offsets, newest commit first until all are found."""
        found: list[FileRange] = []
        open_from = {p: start.get(p, 0) for p, n in end.items() if start.get(p, 0) < n}
        store, names = self._names()
        missing = dict(open_from)
        for name in reversed(names):
            if not missing:
                break
            commit = self._commit(store, name)
            for p in list(missing):
                first, last = max(open_from[p], commit.first.get(p, 0)), min(end[p], commit.end.get(p, 0))
                if first < last:
                    found += self._files(store, commit, p, first, last)
                if commit.first.get(p, 0) <= open_from[p]:
                    del missing[p]
        beyond = {p: n for p, n in end.items() if p in open_from and n > self.ends().get(p, 0)}
        if self.strict and (missing or beyond):
            raise RuntimeError(
                f"offsets of {self.path} are gone: asked from {start} to {end}, "
                f"kept from {self.earliest()} to {self.ends()}"
            )
        return found

    def _files(
        self, store: fs.FileSystem, commit: Commit, partition: str, first: int, end: int
    ) -> list[FileRange]:
        _, root = _file_system(f"{self.path}/{commit.folder}/partition={partition}")
        files = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        scheme = "" if isinstance(store, fs.LocalFileSystem) else self.path.split("://")[0] + "://"
        return [
            FileRange(scheme + f.path, int(partition), first, end)
            for f in files
            if f.path.endswith(".parquet")
        ]

    def read(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        store, name = _file_system(part.file)
        with store.open_input_file(name) as file:
            source = pq.ParquetFile(file)
            for batch in source.iter_batches(columns=[c for c in ARROW_ROW.names if c != "partition"]):
                offset = batch.column("offset")
                inside = pc.and_(pc.greater_equal(offset, part.first), pc.less(offset, part.end))
                rows = pa.Table.from_batches([batch.filter(inside)])
                number = pa.array([part.partition] * rows.num_rows, pa.int32())
                rows = rows.append_column("partition", number).select(ARROW_ROW.names)
                yield from rows.cast(ARROW_ROW).to_batches()


class _TableReader(DataSourceReader):
    def __init__(self, log: _Log) -> None:
        self.log = log

    def partitions(self) -> Sequence[InputPartition]:
        start, end = self.log.named("startingOffsets", "earliest"), self.log.named("endingOffsets", "latest")
        return self.log.ranges(start, end) or [FileRange("", 0, 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from self.log.read(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are kept by Spark's checkpoint; ``position`` only shares out new rows."""

    def __init__(self, log: _Log) -> None:
        self.log = log
        self.limit = int(log.options.get("maxRowsPerTrigger", "0"))
        self.position: Offsets | None = None

    def initialOffset(self) -> dict:
        self.position = self.log.named("startingOffsets", "latest")
        return self.position

    def latestOffset(self) -> dict:
        """All that is there; under a limit an equal share of it for each partition.

        After a restart the position is unknown until the first batch is planned, so that
        batch is not limited.
        """
        ends = self.log.ends()
        if self.limit and self.position is not None:
            share = max(1, self.limit // max(1, len(ends)))
            ends = {p: max(self.position.get(p, 0), min(n, self.position.get(p, 0) + share)) for p, n in ends.items()}
        self.position = ends
        return ends

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.position = end
        return self.log.ranges(start, end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class KeyedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LOG_ROW

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _TableReader(_Log(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(_Log(self.options))
