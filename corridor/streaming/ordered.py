"""Row numbers and previous values per key on a stream, in the order of event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: The event time in microseconds, the first column of every row that waits.
AT = "at_micros"
#: Numbered rows that leave a key together.
ROWS_OUT = 50_000


def packed(rows: pa.Table) -> tuple[bytes]:
    """Rows as one element of the list state: Arrow's stream format."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(rows)
    return (sink.getvalue().to_pybytes(),)


def unpacked(element: tuple[bytes]) -> pa.Table:
    return pa.ipc.open_stream(element[0]).read_all()


class InOrder(StatefulProcessor):
    """Holds the rows of a key until the watermark has passed them, then numbers them.

    The state of a key is the number and the carried values of its last numbered row,
    and the rows that later ones may still precede: what arrived within the watermark's
    delay. They wait as Arrow batches, not row by row. A timer of the earliest waiting row
    wakes it.
    """

    def __init__(
        self,
        columns: Sequence[str],
        keys: Sequence[str],
        order: Sequence[str],
        carry: Sequence[str],
        waiting: T.StructType,
    ) -> None:
        self.columns, self.keys, self.carry = list(columns), list(keys), list(carry)
        self.order, self.waiting_type = [AT, *order], waiting

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState(
            "last",
            T.StructType(
                [T.StructField("row_no", T.LongType()), *(self.waiting_type[c] for c in self.carry)]
            ),
        )
        self.waiting = handle.getListState(
            "waiting", T.StructType([T.StructField("rows", T.BinaryType())])
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = self.waiting_type.names
        earliest = None
        for part in rows:
            # Names that are no Python names arrive changed; the order of columns is kept.
            part = part.set_axis(self.columns, axis=1)[names]
            self.waiting.appendValue(packed(pa.Table.from_pandas(part, preserve_index=False)))
            first = int(part[AT].min())
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake_at(earliest, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def _wake_at(self, micros: int, watermark_ms: int) -> None:
        """One timer a key: at the earliest row that waits. Expired ones no longer count."""
        due = -(-micros // 1000)
        for other in [t for t in self.handle.listTimers() if t > watermark_ms]:
            if other <= due:
                return
            self.handle.deleteTimer(other)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark_ms = timerValues.getCurrentWatermarkInMs()
        passed = watermark_ms * 1000
        # A part whose values of a column are all null does not know its type.
        rows = pa.concat_tables(map(unpacked, self.waiting.get()), promote_options="permissive")
        ready = rows.filter(pc.field(AT) <= passed)
        later = rows.filter(pc.field(AT) > passed)
        if len(later):
            self.waiting.put([packed(part) for part in _parts(later)])
            self._wake_at(pc.min(later[AT]).as_py(), watermark_ms)
        else:
            self.waiting.clear()
        if not len(ready):
            return
        ready = ready.take(pc.sort_indices(ready, [(c, "ascending") for c in self.order]))
        before = self.last.get() if self.last.exists() else (0, *(None for _ in self.carry))
        for part in _parts(ready):
            out = part.to_pandas(integer_object_nulls=True)
            out.insert(0, "row_no", range(before[0] + 1, before[0] + 1 + len(out)))
            for i, c in enumerate(self.carry, 1):
                out[f"prev_{c}"] = [before[i], *out[c].iloc[:-1]]
            for name, value in zip(self.keys, key):
                out[name] = value
            before = (before[0] + len(out), *(part[c][-1].as_py() for c in self.carry))
            yield out
        self.last.update(before)

    def close(self) -> None:
        pass


def _parts(rows: pa.Table) -> Iterator[pa.Table]:
    return (rows.slice(at, ROWS_OUT) for at in range(0, len(rows), ROWS_OUT))


def number_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """``number_rows`` for a stream with a watermark on ``order[0]``: ``row_no``, ``prev_<c>``.

    A row is returned once the watermark has passed it, so the numbers are final. Rows that
    come later than the watermark allows are dropped. Columns are plain values. The rows of
    one key within the watermark's delay are numbered in one task.
    """
    time, *ties = order
    types = {f.name: f for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c != time]
    waiting = T.StructType([T.StructField(AT, T.LongType()), *(types[c] for c in rest)])
    out = T.StructType(
        [
            *(types[k] for k in keys),
            T.StructField(AT, T.LongType()),
            *(types[c] for c in rest),
            T.StructField("row_no", T.LongType()),
            *(T.StructField(f"prev_{c}", types[c].dataType) for c in carry),
        ]
    )
    placed = df.withColumn(AT, F.unix_micros(time))
    processor = InOrder(placed.columns, keys, ties, carry, waiting)
    numbered = (
        placed.groupBy(*keys)
        .transformWithStateInPandas(processor, out, outputMode="Append", timeMode="EventTime")
    )
    return numbered.withColumn(time, F.timestamp_micros(AT)).select(
        *df.columns, "row_no", *(f"prev_{c}" for c in carry)
    )
