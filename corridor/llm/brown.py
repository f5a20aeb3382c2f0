"""Class-based bigram language model with exchange clustering.

``P(w | previous) = P(class(w) | class(previous)) * P(w | class(w))``. A document is its
lower-case words and one end token, which is also the context of its first word.

Texts are first turned into blocks of about ``BLOCK`` bytes, one row each: a dictionary of
the block's words (64-bit hashes) and all tokens as numbers in it. The exchange reads these
blocks and shuffles no tokens. Blocks are shuffled once, when they are joined to the counts
and classes of their words and stored for the last figures and the scores.

Every word of the training rows gets its class by its neighbours. Words with at least one
``FREQUENT``-th of all training tokens (hence at most ``FREQUENT`` words, a bound that makes
their table safe to broadcast) start in classes by hash and are exchanged: every pass
counts, for each of them, the classes before and after it; every word then moves to the
class that raises the likelihood of the class bigrams most, its own counts taken out. All
other words, however rare, stand outside the classes so far, as one class ``REST``. The
neighbours of each are then brought together in one shuffle, and it joins the class that
raises the likelihood of the class bigrams most. Words that no training row has keep ``REST``;
one's probability is what every class leaves for an unseen word, by the class's own.

Null texts count as empty: the end token alone. Without training rows all probabilities
come from the smoothing. Repeated rows count as often as they occur. A document may be
longer than a block; it then is one of its own. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from corridor.llm.batches import id_and_text, mixed, slices, utf8
from corridor.llm.stored import small_side, stored

BLOCK = 16 << 20
CLASSES = 32
FREQUENT = 1 << 17
PASSES = 4
FOLDS, HELD_OUT = 7, 2
#: Pairs of a word and a neighbour's class that a task counts before it hands them on.
TALLY_KEYS = 1 << 20
#: Words taken from the class bigrams' prior, in tokens.
BACKOFF = 5.0
#: Tokens of a block that a task works on at a time; a longer document is taken whole.
PIECE = 1 << 18

# Classes: those of words, then that of words outside them, then the end token.
REST = CLASSES
END = REST + 1
N_CLASSES = END + 1
#: Rows with the neighbours of a word in a block that leave a task together.
ROWS_OUT = 1 << 16

#: A word of a block that is not frequent: its place there, count, class, whether it leads.
_ENTRY = np.dtype([("at", "<i4"), ("c", "<i8"), ("class", "u1"), ("lead", "u1")])

_BLOCKS = (
    "block bigint, doc_ids array<bigint>, held_out array<boolean>, lengths array<int>,"
    " tokens binary, words array<bigint>, n_train array<int>, n_learnt bigint"
)


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: documents, their tokens, the dictionary and its training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            known: dict[bytes, int] = defaultdict(count().__next__)
            parts, held = [], []
            for _, is_held, text in rows:
                words = text.lower().split()
                parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                held.append(is_held)
            lengths = [len(p) for p in parts]
            tokens = np.concatenate(parts)
            learnt = tokens[np.repeat(~np.array(held, bool), lengths)]
            words = np.fromiter(map(xxh3_64_intdigest, known), np.uint64, len(known))
            values = [
                [next(numbers)],
                [[r[0] for r in rows]],
                [held],
                [lengths],
                [_planes(tokens)],
                [words.view(np.int64)],
                [np.bincount(learnt, minlength=len(known)).astype(np.int32)],
                [len(learnt) + held.count(False)],
            ]
            kinds = [
                pa.int64(),
                pa.list_(pa.int64()),
                pa.list_(pa.bool_()),
                pa.list_(pa.int32()),
                pa.binary(),
                pa.list_(pa.int64()),
                pa.list_(pa.int32()),
                pa.int64(),
            ]
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names
            )

        for batch in slices(batches):
            ids, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row in zip(ids, held, utf8(batch.column(1)), strict=True):
                if rows and size + len(row[2]) > BLOCK:
                    yield flush()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield flush()

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return id_and_text(docs).withColumn("held_out", held).mapInArrow(run, _BLOCKS)


@dataclass
class Corpus:
    """Training totals."""

    n_tokens: int
    n_words: int


@dataclass
class Classes:
    """Classes and training counts of the frequent words, in the order of their hashes."""

    frequent: np.ndarray
    of: np.ndarray
    counts: np.ndarray

    def of_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, and its number among the frequent ones (-1: none)."""
        classes = np.full(len(words), REST, np.int32)
        number = np.full(len(words), -1, np.int32)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
            found = self.frequent[at] == words
            number[found] = at[found]
            classes[found] = self.of[at[found]]
        return classes, number

    def of_block(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, number and training count of each word of a block.

        The others' classes and counts stand in the block, if they have been placed.
        """
        classes, number = self.of_words(row["words"].view(np.uint64))
        counts = np.zeros(len(number), np.int64)
        counts[number >= 0] = self.counts[number[number >= 0]]
        if "entries" in row:
            at = row["entries"]["at"]
            classes[at] = row["entries"]["class"]
            counts[at] = row["entries"]["c"]
        return classes, number, counts


def _planes(tokens: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, compressed: the upper ones are nearly 0."""
    planes = tokens.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True) if planes else b""


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int32)
    planes = pa.decompress(raw, decompressed_size=4 * n, codec="zstd")
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4")[:, 0]


def _sequences(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a block with an end (-1) after each document; where documents end; held out."""
    lengths = row["lengths"].astype(np.int64)
    tokens = _from_planes(row["tokens"], int(lengths.sum()))
    ends = np.cumsum(lengths + 1) - 1
    out = np.full(len(tokens) + len(lengths), -1, np.int32)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = tokens
    return out, ends, row["held_out"].astype(bool)


def _class_rows(row: dict, classes: Classes) -> Iterator[tuple]:
    """A block in pieces of whole documents, so that what is worked out per token stays small.

    Per token its word in the block, class, class before it and number among the frequent
    words; the words' counts; the documents' ends in the piece, held out, and ids.
    """
    tokens, ends, held = _sequences(row)
    of_word, number, counts = classes.of_block(row)
    of_word, number = np.append(of_word, np.int32(END)), np.append(number, np.int32(-1))
    first = 0
    while first < len(ends):
        start = ends[first - 1] + 1 if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + PIECE)))
        piece = tokens[start : ends[last - 1] + 1]
        of = of_word[piece]
        before = np.concatenate((np.array([END], np.int32), of[:-1]))
        ids = row["doc_ids"][first:last] if "doc_ids" in row else None
        yield piece, of, before, number[piece], counts, ends[first:last] - start, held[first:last], ids
        first = last


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks one by one, lists as numpy arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                if name == "entries":
                    row[name] = np.frombuffer(b"".join(column[i].as_py() or []), _ENTRY)
                elif name == "doc_ids" or not pa.types.is_list(column.type):
                    row[name] = column[i].as_py()
                elif column[i].values is None:  # a block without such words
                    row[name] = np.empty(0, np.int64)
                else:
                    row[name] = column[i].values.to_numpy(zero_copy_only=False)
            yield row


class _Tally:
    """How often keys came, with at most about ``TALLY_KEYS`` of them kept at a time."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Count ``keys``; returns counts that no longer fit."""
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)
        if self.size > TALLY_KEYS:
            self._merge()
            if self.size > TALLY_KEYS // 2:
                yield from self.rest()

    def _merge(self) -> None:
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.counts = [np.add.reduceat(np.concatenate(self.counts)[order], starts)]
        self.keys = [keys[starts]]
        self.size = len(starts)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is still counted, which is then forgotten."""
        if self.size:
            self._merge()
            yield self.keys[0], self.counts[0]
        self.keys, self.counts, self.size = [], [], 0


def _statistics(blocks: DataFrame, classes: Classes, contexts: bool) -> DataFrame:
    """Partial counts of a task: class bigrams (number -1) and contexts of frequent words.

    Contexts are counted sparsely, by word and class that occur together, and leave the
    task in parts: it needs as much memory for any vocabulary.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def counts(number: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(c.astype(np.int64)) for c in (number, cell, n)]
        return pa.RecordBatch.from_arrays(columns, ["number", "cell", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        bigrams = np.zeros(N_CLASSES * N_CLASSES, np.int64)
        width = 2 * N_CLASSES
        tally = _Tally()
        for row in _rows_of(batches):
            for _, of, before, number, _, ends, held, _ in _class_rows(row, known):
                learnt = np.repeat(~held, np.diff(np.concatenate(([-1], ends))))
                bigrams += np.bincount(
                    (before * N_CLASSES + of)[learnt], minlength=N_CLASSES * N_CLASSES
                )
                if contexts and len(known.frequent):
                    after = np.append(of[1:], np.int32(END))
                    use = learnt & (number >= 0)
                    base = number[use].astype(np.int64) * width
                    for side, other in enumerate((before, after)):
                        for keys, n in tally.add(base + (side * N_CLASSES + other[use])):
                            yield counts(keys // width, keys % width, n)
        for keys, n in tally.rest():
            yield counts(keys // width, keys % width, n)
        at = np.flatnonzero(bigrams)
        yield counts(np.full(len(at), -1), at, bigrams[at])

    return (
        blocks.select("tokens", "lengths", "held_out", "words", *_placed_columns(blocks))
        .mapInArrow(run, "number bigint, cell bigint, n bigint")
        .groupBy("number", "cell")
        .agg(F.sum("n").alias("n"))
    )


def _bigrams(rows: list) -> np.ndarray:
    out = np.zeros(N_CLASSES * N_CLASSES)
    for r in rows:
        out[r["cell"]] = r["n"]
    return out.reshape(N_CLASSES, N_CLASSES)


def best_classes(of: np.ndarray, around: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class each word should have; ``around`` has rows of counts before and after it.

    A word's own counts leave its class before all classes are compared. Counts of a
    class pair enter as n*log(n / (before * after)), seen through their derivative.
    """
    totals_out, totals_in = bigrams.sum(axis=1), bigrams.sum(axis=0)
    out = of.copy()
    left, right = around[:, :N_CLASSES], around[:, N_CLASSES:]
    for w in range(len(of)):
        now, n = of[w], left[w].sum()
        into = bigrams[:, :CLASSES].copy()  # from any class to a candidate
        onto = bigrams[:CLASSES].copy()  # from a candidate to any class
        size_in, size_out = totals_in[:CLASSES].copy(), totals_out[:CLASSES].copy()
        into[:, now] -= left[w]
        onto[now] -= right[w]
        size_in[now] -= n
        size_out[now] -= n
        gain = left[w] @ np.log(np.maximum(into, 0) + 0.5) - n * np.log(np.maximum(size_in, 0) + 1)
        gain += np.log(np.maximum(onto, 0) + 0.5) @ right[w] - n * np.log(np.maximum(size_out, 0) + 1)
        out[w] = gain.argmax()
    return out


def _exchanged(statistics: DataFrame, classes: Classes, bigrams: np.ndarray) -> Classes:
    """One pass of moves, the frequent words spread over the tasks."""
    shared = statistics.sparkSession.sparkContext.broadcast((classes.of, bigrams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, pairs = shared.value
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            around = np.zeros((len(numbers), 2 * N_CLASSES))
            for i, (cells, n) in enumerate(
                zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ):
                around[i, cells] = n
            moved = best_classes(of[numbers], around, pairs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(moved, pa.int64())], ["number", "class"]
            )

    moved = (
        statistics.where(F.col("number") >= 0)
        .groupBy("number")
        .agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("n"))
        .mapInArrow(run, "number bigint, class bigint")
        .toPandas()
    )
    of = classes.of.copy()
    of[moved["number"].to_numpy()] = moved["class"].to_numpy()
    return Classes(classes.frequent, of, classes.counts)


@dataclass
class Model:
    """Classes with their log10 transitions, sizes and words."""

    corpus: Corpus
    classes: Classes
    transitions: np.ndarray
    tokens: np.ndarray
    words: np.ndarray


def _frequent(blocks: DataFrame, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and training counts of the words with a ``FREQUENT``-th of all tokens.

    A word has less than a quarter of that share of every block where it is not heavy. Only
    words whose heavy blocks and that much of all others could make it frequent are counted.
    """
    least, quarter = max(2, -(-n_tokens // FREQUENT)), F.lit(4 * FREQUENT).cast("bigint")
    entries = blocks.select("n_learnt", F.explode(F.arrays_zip("words", "n_train")).alias("w")).select(
        F.col("w.words").alias("word"), F.col("w.n_train").alias("n"), "n_learnt"
    )
    may = stored(
        entries.where((F.col("n") > 0) & (F.col("n") * quarter >= F.col("n_learnt")))
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("n_learnt").alias("heavy"))
        .where(F.col("n") * quarter + n_tokens - F.col("heavy") >= least * quarter)
        .select("word"),
        "candidates",
    )
    counted = (
        entries.where(F.col("n") > 0)
        .join(small_side(may), "word", "left_semi")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .toPandas()  # at most FREQUENT words: each has that share of all tokens
    )
    hashes = counted["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], counted["n"].to_numpy(np.int64)[order]


def exchange(blocks: DataFrame, n_tokens: int, classes: int = CLASSES, passes: int = PASSES) -> Classes:
    """Classes of the frequent words after some passes of exchange."""
    hashes, counts = _frequent(blocks, n_tokens)
    found = Classes(hashes, (mixed(hashes) % np.uint64(classes)).astype(np.int64), counts)
    for _ in range(passes if len(hashes) else 0):
        statistics = stored(_statistics(blocks, found, True), "statistics")
        bigrams = _bigrams(statistics.where("number = -1").collect())
        found = _exchanged(statistics, found, bigrams)
    return found


def _neighbours(blocks: DataFrame, classes: Classes) -> DataFrame:
    """Per block and word that is not frequent: the classes before and after each training token.

    ``around`` has two bytes for each such token.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for row in _rows_of(batches):
            found, pairs = [np.empty(0, np.int32)], [np.empty((0, 2), np.uint8)]
            for tokens, of, before, number, _, ends, held, _ in _class_rows(row, known):
                learnt = np.repeat(~held, np.diff(np.concatenate(([-1], ends))))
                use = np.flatnonzero(learnt & (number < 0) & (tokens >= 0))
                found.append(tokens[use])
                # A word is never the last token: its document's end follows.
                pairs.append(np.stack((before[use], of[use + 1]), axis=1).astype(np.uint8))
            tokens, around = np.concatenate(found), np.concatenate(pairs)
            around = around[np.argsort(tokens, kind="stable")]
            words = row["words"]
            at = np.flatnonzero(known.of_words(words.view(np.uint64))[1] < 0)
            times = np.bincount(tokens, minlength=len(words))[at]
            ends = np.concatenate(([0], np.cumsum(times)))
            for i in range(0, len(at), ROWS_OUT):
                part = at[i : i + ROWS_OUT]
                offsets = ends[i : i + len(part) + 1]
                data = np.ascontiguousarray(around[offsets[0] : offsets[-1]])
                offsets = (2 * (offsets - offsets[0])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words[part], pa.int64()),
                        pa.array(np.full(len(part), row["block"], np.int64)),
                        pa.array(part.astype(np.int32)),
                        pa.Array.from_buffers(
                            pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
                        ),
                    ],
                    ["word", "block", "at", "around"],
                )

    return blocks.select("block", "tokens", "lengths", "held_out", "words").mapInArrow(
        run, "word bigint, block bigint, at int, around binary"
    )


def joined_classes(times: np.ndarray, around: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The best class of words outside the classes, by the counts of ``best_classes``.

    Sizes are smoothed as their pairs are, so an empty class does not draw all words. Word i has ``times[i]`` rows of ``around``: the classes before and after it. ``REST``
    for words without any.
    """
    totals_out, totals_in = bigrams.sum(axis=1)[:CLASSES], bigrams.sum(axis=0)[:CLASSES]
    into = np.log(bigrams[:, :CLASSES] + 0.5) - np.log(totals_in + 0.5 * N_CLASSES)
    onto = np.log(bigrams[:CLASSES] + 0.5).T - np.log(totals_out + 0.5 * N_CLASSES)
    out = np.full(len(times), REST, np.int32)
    has = np.flatnonzero(times)
    if len(has):
        gain = into[around[:, 0]] + onto[around[:, 1]]
        starts = np.cumsum(times[has]) - times[has]
        out[has] = np.add.reduceat(gain, starts).argmax(axis=1)
    return out


def _placed(blocks: DataFrame, classes: Classes, bigrams: np.ndarray) -> DataFrame:
    """Blocks plus ``entries``: place, count and class of their words that are not frequent.

    ``lead`` marks one of the blocks a word lies in, so that words can be counted. What a
    batch has for a block is one value of bytes.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(bigrams)

    def place(rows: pa.Table) -> pa.RecordBatch:
        words = rows["word"].to_numpy()
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        around = rows["around"].to_pylist()
        n = np.fromiter(map(len, around), np.int64, len(around)) // 2
        times = np.add.reduceat(n, starts)
        pairs = np.frombuffer(b"".join(around), np.uint8).reshape(-1, 2)
        rows_each = np.diff(np.append(starts, len(words)))
        entries = np.zeros(len(words), _ENTRY)
        entries["at"] = rows["at"].to_numpy()
        entries["c"] = np.repeat(times, rows_each)
        entries["class"] = np.repeat(joined_classes(times, pairs, shared.value), rows_each)
        entries["lead"][starts] = 1
        block = rows["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        block, entries = block[order], entries[order]
        cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
        parts = [entries[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cuts[:-1]]), pa.array(parts, pa.binary())], ["block", "entries"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).to_numpy()
            last = int(np.searchsorted(words, words[-1]))
            # The last word's rows wait for more of it.
            if last or (waiting and waiting[-1].column(0)[-1].as_py() != words[0]):
                done = [*waiting, batch.slice(0, last)]
                waiting = []
                yield place(pa.Table.from_batches(done))
            waiting.append(batch.slice(last))
        if waiting:
            yield place(pa.Table.from_batches(waiting))

    per_block = (
        _neighbours(blocks, classes)
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(run, "block bigint, entries binary")
        .groupBy("block")
        .agg(F.collect_list("entries").alias("entries"))
    )
    return blocks.drop("n_train", "n_learnt").join(per_block, "block", "left")


def _placed_columns(blocks: DataFrame) -> list[str]:
    return [c for c in ("entries",) if c in blocks.columns]


def _class_sizes(blocks: DataFrame, classes: Classes) -> np.ndarray:
    """Distinct training words of each class."""
    words = np.bincount(classes.of, minlength=N_CLASSES).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_CLASSES, np.int64)
        for row in _rows_of(batches):
            entries = row["entries"]
            use = (entries["lead"] > 0) & (entries["c"] > 0)
            total += np.bincount(entries["class"][use], minlength=N_CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_CLASSES)), pa.array(total)], ["class", "n"])

    rows = (
        blocks.select("entries")
        .mapInArrow(run, "class bigint, n bigint")
        .groupBy("class")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    for r in rows:
        words[r["class"]] += r["n"]
    words[END] = 1
    return words


def score(blocks: DataFrame, model: Model) -> DataFrame:
    """Per document its tokens, the unigram base score and the score of the model."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n, v = m.corpus.n_tokens, m.corpus.n_words
        n_end = m.tokens[END]
        room = np.log10(m.tokens + m.words + 1)
        # What the classes leave for a word that no training row has, by the class before it.
        unseen = np.log10((10 ** (m.transitions - room))[:, :CLASSES].sum(axis=1))
        for row in _rows_of(batches):
            for tokens, of, before, _, counts, ends, held, ids in _class_rows(row, m.classes):
                c = np.append(counts, n_end)[tokens].astype(np.float64)
                starts = np.concatenate(([0], ends[:-1] + 1))
                base = np.log10((c + 1) / (n + v + 1))
                own = m.transitions[before, of] + np.log10(c + 1) - room[of]
                own = np.where(of == REST, unseen[before], own)
                size = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(held),
                        pa.array(ends - starts + 1),
                        pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                        pa.array(np.full(size, n, np.int64)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(own, starts)),
                    ],
                    [f.split()[0] for f in _SCORES.split(", ")],
                )

    return blocks.select(
        "doc_ids", "tokens", "lengths", "held_out", "words", *_placed_columns(blocks)
    ).mapInArrow(run, _SCORES)


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def train(first: DataFrame) -> tuple[DataFrame, Model]:
    """Exchange, the classes of all other words, and the final counts; the blocks with them."""
    is_learnt = F.size(F.filter("held_out", lambda h: ~h))
    n_docs, n_tokens = (
        int(n or 0) for n in first.select(is_learnt.alias("docs"), "n_learnt").agg(F.sum("docs"), F.sum("n_learnt")).first()
    )
    found = exchange(first, n_tokens)
    bigrams = _bigrams(_statistics(first, found, False).where("number = -1").collect())
    blocks = stored(_placed(first, found, bigrams), "placed", "zstd")
    bigrams = _bigrams(_statistics(blocks, found, False).where("number = -1").collect())
    shares = (bigrams.sum(axis=0) + 1) / (bigrams.sum() + N_CLASSES)
    smooth = (bigrams + BACKOFF * shares) / (bigrams.sum(axis=1, keepdims=True) + BACKOFF)
    words = _class_sizes(blocks, found)
    corpus = Corpus(n_tokens, int(words.sum()) - (n_docs == 0))
    return blocks, Model(corpus, found, np.log10(smooth), bigrams.sum(axis=0), words)


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the training folds of ``docs`` and score all of them."""
    return score(*train(stored(_blocks(docs), "blocks", "zstd")))
