"""Tables that change with every micro-batch and can be read at any time.

A table is a set of runs, folders that are written once and never changed. A manifest,
one small file per committed batch, names the runs of that version of the table, or of
several tables that change together. A reader takes the newest manifest and reads its
runs; they stay until ``retain`` later versions have been committed. What a failed or
unfinished batch left behind is in no manifest, and a repeated batch changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.sources.folders import Folder

#: Partition column of tables that only grow.
STORED_BATCH = "stored_batch"
#: Versions that stay readable.
RETAIN = 5
#: Runs of one level that are merged into one of the next.
FAN_IN = 8

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Run:
    """The rows that the batches ``first`` to ``last`` left in a table."""

    first: int
    last: int
    level: int = 0

    @property
    def name(self) -> str:
        return f"run-{self.level}-{self.first}-{self.last}"


@dataclass(frozen=True)
class Version:
    """The state after a batch: the runs of each table."""

    batch_id: int = -1
    runs: dict[str, list[Run]] = field(default_factory=dict)

    def of(self, table: str) -> list[Run]:
        return self.runs.get(table, [])

    def text(self) -> str:
        runs = {t: [[r.first, r.last, r.level] for r in rs] for t, rs in self.runs.items()}
        return json.dumps({"batch_id": self.batch_id, "runs": runs})

    @classmethod
    def parse(cls, text: str) -> Version:
        values = json.loads(text)
        return cls(
            values["batch_id"], {t: [Run(*r) for r in rs] for t, rs in values["runs"].items()}
        )


def compaction(runs: list[Run], fan_in: int = FAN_IN) -> tuple[list[Run], Run] | None:
    """The last runs to merge into one, if there are enough of a level.

    ``fan_in`` runs of the lowest level become one of the next, as digits carry: after n
    batches there are at most ``fan_in - 1`` runs on each of about log(n) levels, and a
    row has been rewritten at most once per level.
    """
    left = list(runs)
    while len(left) >= fan_in and len({r.level for r in left[-fan_in:]}) == 1:
        last = left[-fan_in:]
        left = [*left[:-fan_in], Run(last[0].first, last[-1].last, last[0].level + 1)]
    if len(left) == len(runs):
        return None
    return [r for r in runs if r.first >= left[-1].first], left[-1]


class Versions:
    """The versions below one folder."""

    def __init__(
        self, spark: SparkSession, path: str, fmt: str = "parquet", retain: int = RETAIN
    ) -> None:
        self.spark, self.path, self.fmt, self.retain = spark, path.rstrip("/"), fmt, retain
        self.manifests = Folder(spark, f"{self.path}/manifests")

    def _stored(self) -> list[str]:
        return [n for n in self.manifests.names() if n.endswith(".json")]

    def newest(self) -> Version:
        """The last committed version; an empty one before the first."""
        names = self._stored()
        return Version.parse(self.manifests.read(names[-1])) if names else Version()

    def at(self, table: str, run: Run) -> str:
        return f"{self.path}/{table}/{run.name}"

    def read(self, table: str, runs: list[Run]) -> DataFrame:
        return self.spark.read.format(self.fmt).load([self.at(table, r) for r in runs])

    def write(self, table: str, run: Run, rows: DataFrame) -> Run:
        """Store a run; one that an unfinished batch left is replaced."""
        rows.write.format(self.fmt).mode("overwrite").save(self.at(table, run))
        return run

    def add(self, table: str, runs: list[Run], run: Run, merge: Merge, fan_in: int = FAN_IN) -> list[Run]:
        """The runs of a table after one more, the last ones merged when there are enough."""
        runs = [*runs, run]
        due = compaction(runs, fan_in)
        if due is None:
            return runs
        taken, merged = due
        self.write(table, merged, merge(self.read(table, taken)))
        return [*runs[: -len(taken)], merged]

    def append(self, table: str, batch_id: int, rows: DataFrame) -> DataFrame:
        """Store the rows a batch adds to a table that only grows; returns what is stored.

        Each batch has its own folder, which counts once the batch is committed.
        """
        folder = f"{self.path}/{table}/{STORED_BATCH}={batch_id}"
        rows.write.format(self.fmt).mode("overwrite").save(folder)
        return self.spark.read.format(self.fmt).schema(rows.schema).load(folder)

    def read_appended(self, table: str) -> DataFrame:
        """The rows of all committed batches, with the number of each row's batch."""
        newest = self.committed()
        rows = self.spark.read.format(self.fmt).load(f"{self.path}/{table}")
        return rows.where(F.col(STORED_BATCH) <= newest)

    def committed(self) -> int:
        """The number of the newest committed batch."""
        newest = self.newest()
        if newest.batch_id < 0:
            raise FileNotFoundError(f"no batch has been committed below {self.path}")
        return newest.batch_id

    def commit(self, version: Version) -> None:
        """Make ``version`` the newest, then remove runs and manifests no reader may need.

        There is one writer, so a run that no kept version names is either old or what
        an unfinished batch left.
        """
        self.manifests.write(f"{version.batch_id:020d}.json", version.text())
        names = self._stored()
        kept = [Version.parse(self.manifests.read(n)) for n in names[-self.retain :]]
        for table in version.runs:
            folder = Folder(self.spark, f"{self.path}/{table}")
            used = {run.name for v in kept for run in v.of(table)}
            for name in set(folder.names()) - used:
                folder.remove(name)
        for name in names[: -self.retain]:
            self.manifests.remove(name)
