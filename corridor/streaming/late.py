"""How many late rows a query has dropped, over all its batches and restarts."""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from corridor.sources.folders import Folder


class LateRows(StreamingQueryListener):
    """Adds up the rows that watermarks dropped, for every query of the session.

    A progress report tells of one batch and a query remembers the last hundred, so the
    sums are kept here: one small file per query below ``path``, named by the query's id,
    which its checkpoint keeps over restarts. Put ``path`` beside the checkpoints. A batch
    counts once, however often it is reported.

    Rows are counted where they are dropped: in an aggregate, after each task has combined
    its rows of the batch, so several events of a window and train are one row, and an
    event counts in each of its windows.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def _state(self, query_id: str) -> tuple[Folder, dict]:
        folder = Folder(self.spark, f"{self.path}/{query_id}")
        names = [n for n in folder.names() if n.endswith(".json")]
        return folder, json.loads(folder.read(names[-1])) if names else {"batch_id": -1, "rows": 0}

    def count(self, query: StreamingQuery, wait_sec: float = 30.0) -> int:
        """Rows dropped so far; reports of finished batches are waited for."""
        done = query.lastProgress["batchId"] if query.lastProgress else -1
        deadline = time.monotonic() + wait_sec
        while (state := self._state(str(query.id))[1])["batch_id"] < done:
            if time.monotonic() > deadline:
                raise TimeoutError(f"no report of batch {done} of query {query.id}")
            time.sleep(0.05)
        return state["rows"]

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        folder, state = self._state(str(progress.id))
        if progress.batchId <= state["batch_id"]:
            return
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        text = json.dumps({"batch_id": progress.batchId, "rows": state["rows"] + dropped})
        name = f"{progress.batchId:020d}.json"
        folder.write(name, text)
        for old in folder.names():
            if old.endswith(".json") and old < name:
                folder.remove(old)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
