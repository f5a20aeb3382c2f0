"""Hierarchical packing of token sequences into several context sizes.

Every partition of the input is packed by itself while it is read: no shuffle, and no
more memory than one batch of documents. A document of at least the longest context
gives whole windows first; what is left of it, and every shorter document, is routed to
the smallest tier that holds it. Tiers are packed from the longest on. The gap that the
first piece leaves in a window is filled with the largest pieces of shorter tiers that
fit, and at last with a cut from a piece, so that windows are full. Only the end of a
partition (less than the smallest tier) leaves one sequence to be padded.

Closed windows are dealt into step groups of ``STEP_TOKENS`` tokens, one tier each; what
remains of all tiers at the end of a partition shares groups of the same size.

Null texts count as empty and give their end token. A null ``doc_id`` stays null, equal
rows are packed one by one, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corridor.llm.batches import id_and_text, slices
from corridor.llm.tokens import encode

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 8192
END_ID = 0

COLUMNS = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, tier int, step_group bigint"
)
_ARROW = pa.schema(
    [(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in COLUMNS.split(", ")]
)
#: Room for the number of a sequence below the number of its partition.
_PARTITION_BITS = 33

# (doc_id, start, ids, tokens of the document)
Piece = tuple[int | None, int, np.ndarray, int]


class TierPacker:
    """Packs the pieces of one partition; ``emit`` gets every finished row."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, first_id: int) -> None:
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        self.longest = self.tiers[-1]
        self.by_length: list[list[Piece]] = [[] for _ in range(self.longest + 1)]
        self.lengths = 0  # bit n: a piece of n tokens waits
        self.tokens = 0
        self.sequence, self.group = first_id, first_id
        self.waiting: dict[int, list[list[tuple]]] = {t: [] for t in self.tiers}
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Take a document: whole windows at once, the rest into its tier."""
        n = len(ids)
        whole = n - n % self.longest
        for start in range(0, whole, self.longest):
            self._close(self.longest, [(doc_id, start, ids[start : start + self.longest], n)])
        if whole < n:
            self._put((doc_id, whole, ids[whole:], n))

    def pack(self) -> None:
        """Close every window that the waiting pieces can fill."""
        shorter = (0, *self.tiers[:-1])
        for size, low in zip(reversed(self.tiers), reversed(shorter), strict=True):
            while self.tokens >= size and (first := self._largest(size, above=low)):
                self._close(size, [piece := self._take(first), *self._fill(size - len(piece[2]))])

    def finish(self) -> None:
        """Close what is left: full windows of falling size, then one padded sequence."""
        self.pack()
        for size in reversed(self.tiers):
            while self.tokens >= size:
                self._close(size, self._fill(size))
        if self.tokens:
            self._close(self.tiers[0], self._fill(self.tokens))
        held = [s for size in reversed(self.tiers) for s in self.waiting[size]]
        group: list[list[tuple]] = []
        tokens = 0
        for sequence in held:
            size = sum(row[2] for row in sequence)
            if tokens + size > self.step_tokens:
                self._deal(group)
                group, tokens = [], 0
            group.append(sequence)
            tokens += size
        self._deal(group)

    def _put(self, piece: Piece) -> None:
        n = len(piece[2])
        self.by_length[n].append(piece)
        self.lengths |= 1 << n
        self.tokens += n

    def _take(self, n: int) -> Piece:
        piece = self.by_length[n].pop()
        if not self.by_length[n]:
            self.lengths ^= 1 << n
        self.tokens -= n
        return piece

    def _largest(self, most: int, above: int = 0) -> int:
        """Length of the longest waiting piece in (above, most], else 0."""
        n = (self.lengths & ((2 << most) - 1)).bit_length() - 1
        return n if n > above else 0

    def _fill(self, gap: int) -> Iterator[Piece]:
        """Pieces of ``gap`` tokens together; the last may be cut off a longer one."""
        while gap:
            if n := self._largest(gap):
                yield self._take(n)
                gap -= n
                continue
            longer = self.lengths >> (gap + 1) << (gap + 1)
            doc_id, start, ids, total = self._take((longer & -longer).bit_length() - 1)
            self._put((doc_id, start + gap, ids[gap:], total))
            yield doc_id, start, ids[:gap], total
            gap = 0

    def _close(self, size: int, parts) -> None:
        rows, offset = [], 0
        for doc_id, start, ids, total in parts:
            check = crc32(np.ascontiguousarray(ids))
            rows.append((doc_id, start, len(ids), check, total, self.sequence, offset, size))
            offset += len(ids)
        self.sequence += 1
        held = self.waiting[size]
        held.append(rows)
        if len(held) * size >= self.step_tokens:
            self._deal(held)
            self.waiting[size] = []

    def _deal(self, sequences: list[list[tuple]]) -> None:
        self.rows += [(*row, self.group) for rows in sequences for row in rows]
        self.group += 1

    def taken(self) -> pa.RecordBatch:
        """The finished rows so far."""
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
        )


def pack_documents(
    docs: DataFrame,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    encoder: Callable[[str], np.ndarray] = encode,
) -> DataFrame:
    """One row per piece: where it lies in its document, its sequence and its step group."""
    end = np.array([END_ID], "<u4")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = TierPacker(tiers, step_tokens, TaskContext.get().partitionId() << _PARTITION_BITS)
        for batch in slices(batches):
            doc_ids, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, text in zip(doc_ids, texts, strict=True):
                packer.add(doc_id, np.concatenate((encoder(text), end)))
            packer.pack()
            yield packer.taken()
        packer.finish()
        yield packer.taken()

    return id_and_text(docs).mapInArrow(pack, COLUMNS)
