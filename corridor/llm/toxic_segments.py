"""Toxic passages as maximal-scoring segments of token log-odds.

Learning: for both labels the texts that hold a word are counted (once each, so that a
word repeated within one text proves nothing); the log-odds of a word get a Dirichlet
prior, flat plus in proportion to its count in both, and words whose log-odds are not
significant drop out. Every other word counts ``-DRIFT``, so scores fall on average.

Scoring: one scan finds all maximal segments of a text (Ruzzo and Tompa), in linear time.
For texts without toxic passages the best segment follows an extreme-value law,
``P(S >= x) = 1 - exp(-K n exp(-L x))`` for n words: L solves the equation of Karlin and
Altschul for the word scores of clean texts, K is its maximum-likelihood value. Segments
are normalised with it, and a logistic function of the best and of the sum over all
significant ones gives the score.

Learning uses at most ``TRAIN_ROWS`` labelled rows (smallest hashes of ``doc_id``), a
parameter, whole; labels other than 0 and 1 are left out. All texts are scored whole,
without a shuffle. Null and empty texts have no segments and get the lowest score. Equal
rows give equal scores. Without labelled rows all scores are 0, an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import id_and_text, slices, utf8
from corridor.llm.byte_cnn import held_out, learns

TRAIN_ROWS = 6000
#: The prior of a word: a flat part, and its share of this many words.
FLAT, PRIOR = 0.5, 500.0
#: Least standard deviations of a log-odds from 0.
SIGNIFICANT = 2.5
DRIFT = 0.15
#: Segments expected by chance per text below which one is significant.
EXPECTED = 0.05
THRESHOLD = 0.5

#: ASCII letters in lower case; all other ASCII bytes separate words.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


@dataclass(frozen=True)
class Segment:
    """Words ``start`` to ``end`` (exclusive) of a text and their total score."""

    start: int
    end: int
    score: float


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[Segment]:
    """All maximal-scoring segments; ``scores`` has (place, score) of the words that differ from ``-drift``.

    Each candidate keeps the total before it and up to its end. A new one is joined to the
    last earlier candidate that began lower, unless that one also ended as high. The place
    of that earlier candidate is kept too: a search goes from there, since all candidates
    in between began no lower, and so passes each candidate at most once in all.
    """
    # start, end, total before, total after, last earlier candidate that began lower
    found: list[tuple[int, int, float, float, int]] = []
    total, next_place = 0.0, 0
    for place, score in scores:
        total -= drift * (place - next_place)
        next_place = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        start, left = place, before
        lower = len(found) - 1
        while True:
            while lower >= 0 and found[lower][2] >= left:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= total:
                break
            start, _, left, _, earlier = found[lower]
            del found[lower:]
            lower = earlier
        found.append((start, place + 1, left, total, lower))
    return [Segment(start, end, right - left) for start, end, left, right, _ in found]


@dataclass(frozen=True)
class Model:
    """Word scores, the extreme-value law of clean texts, and the logistic weights."""

    scores: dict[bytes, float]
    rate: float
    scale: float
    weights: tuple[float, float, float]

    def segments(self, words: list[bytes]) -> list[Segment]:
        known = self.scores
        hits = [(i, known[w]) for i, w in enumerate(words) if w in known]
        return maximal_segments(hits, DRIFT)

    def normalised(self, score: float, n_words: int) -> float:
        """Minus the log of the segments of this score expected by chance."""
        return self.rate * score - log(self.scale * max(1, n_words))

    def features(self, words: list[bytes]) -> tuple[float, float]:
        """Best normalised segment, and the sum over significant ones (both from 0)."""
        values = [self.normalised(s.score, len(words)) for s in self.segments(words)]
        return max([0.0, *values]), sum(v for v in values if v >= -log(EXPECTED))

    def score(self, words: list[bytes]) -> float:
        best, total = self.features(words)
        a, b, c = self.weights
        return 1 / (1 + exp(-min(50.0, max(-50.0, a + b * log(1 + best) + c * log(1 + total)))))


def _labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    named = (
        labels.where(F.col(label).isin(0, 1) & learns(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    return id_and_text(docs).join(F.broadcast(named), "doc_id").select("label", "text")


def lexicon(labelled: DataFrame) -> tuple[dict[bytes, float], float]:
    """Significant words with their log-odds, and what they make of clean words at most.

    The second value is the rate L of the extreme-value law.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = (Counter(), Counter())
            for label, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                counts[label].update(set(words_of(text)))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    *(pa.array([c[w] for w in words], pa.int64()) for c in counts),
                ],
                ["word", "clean", "toxic"],
            )

    counted = (
        labelled.mapInArrow(count, "word binary, clean bigint, toxic bigint")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    totals = counted.agg(F.sum("clean"), F.sum("toxic"), F.count("*")).first()
    n_clean, n_toxic, n_words = (float(n or 0) for n in totals)
    if not n_clean or not n_toxic:
        return {}, 1.0
    share = PRIOR / (n_clean + n_toxic)
    prior = F.lit(FLAT) + F.lit(share) * (F.col("clean") + F.col("toxic"))
    weight = PRIOR + FLAT * n_words

    def odds(n: str, total: float):
        return F.log((F.col(n) + prior) / (F.lit(total + weight) - F.col(n) - prior))

    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    rows = (
        counted.withColumn("odds", odds("toxic", n_toxic) - odds("clean", n_clean))
        .withColumn("z", F.col("odds") / spread)
        .where(F.abs("z") >= SIGNIFICANT)
        .collect()
    )
    # In a fixed order, so that sums do not depend on that of the rows.
    rows = sorted(rows, key=lambda r: bytes(r["word"]))
    scores = {bytes(r["word"]): r["odds"] - DRIFT for r in rows}
    # Frequencies in clean texts, with the prior so that none is 0.
    weights = np.array([r["clean"] + FLAT + share * (r["clean"] + r["toxic"]) for r in rows])
    shares = weights / (n_clean + weight)
    values = np.array(list(scores.values()))
    return scores, _rate(values, shares)


def _rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of E[exp(L * score)] = 1, by bisection."""
    rest = 1 - shares.sum()

    def excess(rate: float) -> float:
        return float((shares * np.exp(rate * values)).sum() + rest * exp(-rate * DRIFT) - 1)

    low, high = 1e-6, 1.0
    if not (values > 0).any() or excess(low) >= 0:
        return 1.0
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    labelled = _labelled(docs, labels, label, rows)
    scores, rate = lexicon(labelled)
    bare = Model(scores, rate, 1.0, (0.0, 0.0, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in utf8(batch.column(1)):
                words = words_of(text)
                found = sorted((s.score for s in bare.segments(words)), reverse=True)
                out.append((len(words), found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.float64()))],
                ["label", "n", "found"],
            )

    # At most as many small rows as there are labelled rows.
    measured = sorted(
        labelled.mapInArrow(measure, "label int, n bigint, found array<double>").collect(),
        key=lambda r: (r["label"], r["n"], r["found"]),
    )
    clean = [r for r in measured if r["label"] == 0]
    if not clean or len(clean) == len(measured):
        return Model({}, 1.0, 1.0, (-50.0, 0.0, 0.0))
    reached = sum(max(1, r["n"]) * exp(-rate * max([0.0, *r["found"]])) for r in clean)
    law = Model(scores, rate, len(clean) / reached, (0.0, 0.0, 0.0))
    x = []
    for r in measured:
        values = [law.normalised(s, r["n"]) for s in r["found"]]
        best = max([0.0, *values])
        x.append((1.0, log(1 + best), log(1 + sum(v for v in values if v >= -log(EXPECTED)))))
    weights = _logistic(np.array(x), np.array([float(r["label"]) for r in measured]))
    return Model(scores, rate, law.scale, tuple(weights.tolist()))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a small penalty."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        gradient = x.T @ (p - y) + ridge * weights
        weights -= np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), gradient
        )
    return weights


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: ``doc_id``, its words (start, end exclusive), score, expected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = words_of(text)
                for s in model.segments(words):
                    expected = exp(-model.normalised(s.score, len(words)))
                    if expected <= EXPECTED:
                        rows.append((doc_id, s.start, s.end, s.score, expected))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "start_word", "end_word", "score", "expected"],
            )

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, start_word int, end_word int, score double, expected double"
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``n_passages``, the significant segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lowest = model.score([])
        for batch in slices(batches):
            scores, counts = [], []
            for text in utf8(batch.column(1)):
                words = words_of(text)
                if model.scores.keys().isdisjoint(words):
                    scores.append(lowest)
                    counts.append(0)
                    continue
                scores.append(model.score(words))
                counts.append(
                    sum(
                        model.normalised(s.score, len(words)) >= -log(EXPECTED)
                        for s in model.segments(words)
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                ["doc_id", "score", "n_passages"],
            )

    return id_and_text(docs).mapInArrow(run, "doc_id bigint, score double, n_passages bigint")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the learning folds of ``labels`` and score every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_passages",
    )
