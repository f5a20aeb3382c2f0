"""A byte-level convolutional network in numpy that scores the quality of whole texts.

A text is cut into overlapping chunks that cover all its bytes. Each byte has a learned
vector; learned filters run over ``WIDTH`` bytes at every ``STRIDE``-th place of a chunk
and are max-pooled over it. A text has the mean and the maximum of its chunks' pooled
values, and a logistic layer turns them into one probability. Scoring is one pass over
the documents, in batches of chunks, without a shuffle.

The network is fitted on at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hashes of ``doc_id``; both labels weigh the same) and on at most ``TRAIN_CHUNKS`` chunks of
each, spread evenly over its text. Both bounds are parameters; scoring has none.

Null and empty texts are one chunk of padding and get the score of that. Equal rows give
equal scores. Labels other than 0 and 1 are left out. Without any labelled row every score
is 0.5, an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import id_and_text, slices, utf8

CHUNK, STEP = 512, 448
WIDTH, STRIDE = 6, 3
DIMENSION, FILTERS = 6, 16
TRAIN_ROWS, TRAIN_CHUNKS = 2000, 4
EPOCHS, BATCH, RATE = 12, 32, 0.01
THRESHOLD = 0.3
_PAD = 256


@dataclass
class Network:
    """Weights; row 256 of ``vectors`` stands for padding."""

    vectors: np.ndarray  # 257 x DIMENSION
    filters: np.ndarray  # WIDTH * DIMENSION x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return Network(
            normal(_PAD + 1, DIMENSION, scale=0.5),
            normal(WIDTH * DIMENSION, FILTERS, scale=(WIDTH * DIMENSION) ** -0.5),
            np.zeros(FILTERS, np.float32),
            normal(2 * FILTERS, scale=0.2),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.weights, self.offset]

    def table(self) -> list[np.ndarray]:
        """What each byte at each place of a filter adds: WIDTH arrays of 257 x FILTERS."""
        parts = self.filters.reshape(WIDTH, DIMENSION, FILTERS)
        return [np.ascontiguousarray(self.vectors @ part) for part in parts]

    def pooled(self, chunks: np.ndarray, table: list[np.ndarray]) -> np.ndarray:
        """Max-pooled, rectified filter values: one row per chunk."""
        starts = np.arange(0, CHUNK - WIDTH + 1, STRIDE)
        total = table[0][chunks[:, starts]]
        for i in range(1, WIDTH):
            total += table[i][chunks[:, starts + i]]
        return np.maximum(total.max(axis=1) + self.bias, 0)

    def logits(self, pooled: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One value per text, whose chunks are consecutive rows of ``pooled``."""
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        mean = np.add.reduceat(pooled, starts) / counts[:, None]
        most = np.maximum.reduceat(pooled, starts)
        return np.concatenate((mean, most), axis=1) @ self.weights + self.offset[0]


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks of all texts (padded), and how many each text has."""
    counts = np.array([max(1, -(-(len(t) - CHUNK) // STEP) + 1) for t in texts], np.int64)
    out = np.full((int(counts.sum()), CHUNK), _PAD, np.int16)
    row = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        raw = np.frombuffer(text, np.uint8)
        for i in range(n):
            part = raw[i * STEP : i * STEP + CHUNK]
            out[row, : len(part)] = part
            row += 1
    return out, counts


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam on the logistic loss; both labels weigh the same."""
    net, rng = Network.fresh(), np.random.default_rng(11)
    if not len(labels):
        net.weights[:] = 0
        return net
    share = np.array([max(1, (labels == y).sum()) for y in (0, 1)]) / len(labels)
    weight = (0.5 / share)[labels].astype(np.float32)
    every, counts = chunks_of(texts)
    first = np.concatenate(([0], np.cumsum(counts)))
    starts = np.arange(0, CHUNK - WIDTH + 1, STRIDE)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            chunks = np.concatenate([every[first[r] : first[r + 1]] for r in rows])
            n, owner = counts[rows], np.repeat(np.arange(len(rows)), counts[rows])
            windows = chunks[:, starts[:, None] + np.arange(WIDTH)]
            seen = net.vectors[windows].reshape(len(chunks), len(starts), -1)
            values = seen @ net.filters
            best = values.argmax(axis=1)
            pooled = np.take_along_axis(values, best[:, None], 1)[:, 0] + net.bias
            active = pooled > 0
            pooled = np.maximum(pooled, 0)
            begin = np.concatenate(([0], np.cumsum(n)[:-1]))
            mean = np.add.reduceat(pooled, begin) / n[:, None]
            most = np.maximum.reduceat(pooled, begin)
            joined = np.concatenate((mean, most), axis=1)
            p = 1 / (1 + np.exp(-(joined @ net.weights + net.offset[0])))
            error = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            d_weights, d_offset = error @ joined, error.sum(keepdims=True)
            d_joined = error[:, None] * net.weights
            d_pooled = (d_joined[:, :FILTERS] / n[:, None])[owner]
            is_most = pooled == most[owner]
            d_pooled = (d_pooled + d_joined[:, FILTERS:][owner] * is_most) * active
            # Only the place with the largest value of each chunk and filter learns.
            picked = np.take_along_axis(seen, best[:, :, None].astype(np.int64), 1)
            d_filters = np.einsum("cfd,cf->df", picked, d_pooled)
            d_seen = d_pooled[:, :, None] * net.filters.T[None]
            at_bytes = np.take_along_axis(windows, best[:, :, None], 1)
            d_vectors = np.zeros_like(net.vectors)
            np.add.at(
                d_vectors, at_bytes.reshape(-1), d_seen.reshape(-1, WIDTH, DIMENSION).reshape(-1, DIMENSION)
            )
            step += 1
            gradients = [d_vectors, d_filters, d_pooled.sum(axis=0), d_weights, d_offset]
            for value, gradient, (m, v) in zip(net.parameters(), gradients, moments, strict=True):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient**2 - v)
                value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS, chunks: int = TRAIN_CHUNKS
) -> tuple[list[bytes], np.ndarray]:
    """At most ``rows`` texts of learning folds, at most ``chunks`` chunks of each."""
    named = (
        labels.where(F.col(label).isin(0, 1) & learns(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    text = F.col("text")
    apart = F.greatest(F.lit(CHUNK), (F.length(text) / chunks).cast("int"))
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(chunks - 1)), lambda i: F.substring(text, i * apart + 1, F.lit(CHUNK))
    )
    found = (
        id_and_text(docs)
        .join(F.broadcast(named), "doc_id")
        .select("doc_id", "label", F.array_join(parts, "").alias("text"))
        .orderBy("doc_id", "text")
        .limit(rows)
        .collect()
    )
    return [r["text"].encode() for r in found], np.array([r["label"] for r in found], np.int64)


def learns(doc_id) -> object:
    """Rows whose labels may be used: crc32 of the id as text, modulo 5, is not 0."""
    return ~held_out(doc_id)


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def probabilities(net: Network, table: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    """The score of each text."""
    every, counts = chunks_of(texts)
    pooled = np.concatenate(
        [net.pooled(every[i : i + 64], table) for i in range(0, len(every), 64)]
    )
    return 1 / (1 + np.exp(-net.logits(pooled, counts).astype(np.float64)))


def accepted(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = net.table()
        for batch in slices(batches, 1 << 20):
            texts = [t or b"" for t in utf8(batch.column(batch.schema.get_field_index("text")))]
            yield batch.filter(pa.array(probabilities(net, table, texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id`` and ``score``, the probability of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = net.table()
        for batch in slices(batches, 1 << 20):
            p = probabilities(net, table, utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD
) -> DataFrame:
    """Fit on the learning folds of ``labels`` and score every document."""
    net = fit(*training_rows(docs, labels, label))
    return score(docs, net).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
