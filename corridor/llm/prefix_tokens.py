"""Exact token counts of every prefix of a text, by dynamic programming.

Byte-level BPE has one valid tokenization for each byte string: the one in which every
two neighbours would also be the tokens of their own concatenation. So the encoding of a
prefix is that of a shorter prefix plus one last token, and ``count[i] = count[j] + 1``
for the only ``j`` whose last token goes together with the bytes ``j..i``. The counts of
pre-tokens are remembered and added up along the text.

A prefix ends after any code point. Two things make its pre-tokens other than the cut
pre-tokens of the whole text, and both are put right: the last of several white-space
characters starts a pre-token of its own only if something follows, and an apostrophe
suffix is one only when it is whole.

Null texts count as empty (no prefixes, 0 tokens); very long texts and words are handled
like any other; equal rows give equal rows; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import id_and_text, slices
from corridor.llm.tokens import (
    END_OF_TEXT,
    MEMO_PIECES,
    NOT_PLAIN,
    library,
    ranks,
    vocabulary_file,
)

LIMIT = 512
#: Longer words are not remembered, which bounds what a worker remembers.
MEMO_BYTES = 64

_SPLIT = regex.compile(public_tokenizers.PATTERN)
_SUFFIX = re.compile("'(?:re|ve|ll)")


class PrefixCounts:
    """Counts for the prefixes of pre-tokens of one vocabulary, remembered."""

    def __init__(self, rank_file: str) -> None:
        self.ranks = ranks(rank_file)
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.splits: dict[bytes, tuple[bytes, ...]] = {}
        self.words: dict[str, list[int]] = {}
        self.spaced = SpacedCounts(self)
        # Finds the tokens that end at each byte, the longest first.
        self.endings = ahocorasick.Automaton()
        for token in self.ranks:
            self.endings.add_word(token.decode("latin-1"), token)
        self.endings.make_automaton()

    def merged(self, text: bytes, until: int = 1) -> list[bytes]:
        """BPE by its definition: merge the pair of lowest rank until none or ``until`` parts are left."""
        rank, never = self.ranks.get, len(self.ranks)
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > until:
            found = [rank(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
            lowest = min(found)
            if lowest == never:
                break
            i = found.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, ...]:
        """The two parts that the last merge of a token joins."""
        parts = self.splits.get(token)
        if parts is None:
            parts = self.splits[token] = tuple(self.merged(token, until=2))
        return parts

    def go_together(self, left: bytes, right: bytes) -> bool:
        """Whether the tokens stay as they are side by side.

        Their merges are undone, the latest first, down to single bytes. They do not stay
        if the parts that then meet would have been merged before the merge just undone;
        of equal merges the one further left is made first.
        """
        rank = self.ranks
        a, b, limit = left, right, len(rank)
        stays = True
        while stays:
            across = rank.get(a + b)
            if across is not None and across < limit:
                stays = False
            elif len(a) > 1 and (len(b) == 1 or rank[a] > rank[b]):
                limit, a = rank[a], self.split(a)[-1]
            elif len(b) > 1:
                limit, b = rank[b] + 1, self.split(b)[0]
            else:
                break
        if len(self.pairs) >= MEMO_PIECES:
            self.pairs.clear()
        self.pairs[left, right] = stays
        return stays

    def of_bytes(self, text: bytes) -> list[int]:
        """Tokens of each prefix of one pre-token, from 1 byte on."""
        known = self.pairs.get
        counts, last = [0], [b""]
        found = -1
        for end, token in self.endings.iter(text.decode("latin-1")):
            if end == found:
                continue
            start = end + 1 - len(token)
            if start:
                together = known((last[start], token))
                if together is None:
                    together = self.go_together(last[start], token)
                if not together:
                    continue
            counts.append(counts[start] + 1)
            last.append(token)
            found = end
        return counts[1:]

    def of_word(self, word: str) -> list[int]:
        """Tokens of each prefix of one pre-token, by code points."""
        known = self.words.get(word)
        if known is None:
            raw = word.encode()
            known = self.of_bytes(raw)
            if _SUFFIX.fullmatch(word):
                known[1] = 2
            if len(raw) != len(word):
                known = [n for n, b in zip(known, raw[1:] + b"a", strict=True) if b & 0xC0 != 0x80]
            if len(raw) <= MEMO_BYTES:
                if len(self.words) >= MEMO_PIECES:
                    self.words.clear()
                self.words[word] = known
        return known

    def along(self, words: list[str]) -> array:
        """Counts of all prefixes of consecutive pre-tokens."""
        counts, before = array("I"), 0
        for word in words:
            counts.extend([before + n for n in self.of_word(word)])
            before = counts[-1]
        return counts

    def of_text(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text, special strings included."""
        if not text:
            return np.empty(0, "<u4")
        if not NOT_PLAIN.search(text):
            first, *rest = text.split(" ")
            head = self.along(_SPLIT.findall(first)).tobytes()
            return _chained([*((head,) if head else ()), *map(self.spaced.__getitem__, rest)])
        out, before = [], 0
        *closed, rest = text.split(END_OF_TEXT)
        for segment in closed:
            counts = self.of_ordinary(segment + END_OF_TEXT)
            inside = self.of_ordinary(segment)
            counts[-1] = (inside[-1] if len(inside) else 0) + 1
            out.append(counts + np.uint32(before))
            before += int(counts[-1])
        out.append(self.of_ordinary(rest) + np.uint32(before))
        return np.concatenate(out)

    def of_ordinary(self, text: str) -> np.ndarray:
        """Counts of all prefixes when no special string is recognised."""
        if not text:
            return np.empty(0, "<u4")
        cut = library(vocabulary_file("json")).pre_tokenizer.pre_tokenize_str(text)
        words = [text[a:b] for _, (a, b) in cut]
        counts, at = np.array(self.along(words), "<u4"), 0
        for word, following in zip(words, words[1:], strict=False):
            if word.isspace() and following[0].isspace():
                before = int(counts[at - 1]) if at else 0
                run = self.of_word(word + following[0])
                counts[at + len(word)] = before + run[-1]
            at += len(word)
        return counts


class SpacedCounts(dict):
    """Counts for a space and a plain word, as unsigned 32-bit bytes."""

    def __init__(self, counter: PrefixCounts) -> None:
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> bytes:
        value = self.counter.along(_SPLIT.findall(" " + word)).tobytes()
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[word] = value
        return value


def _chained(parts: list[bytes]) -> np.ndarray:
    """Counts of each part moved up by the tokens of the parts before it."""
    counts = np.frombuffer(b"".join(parts), "<u4")
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
    ends = np.cumsum(lengths) - 1
    totals = np.cumsum(counts[ends], dtype=np.uint32)
    return counts + np.repeat(totals - counts[ends], lengths)


@lru_cache(maxsize=2)
def prefix_counter(rank_file: str) -> PrefixCounts:
    return PrefixCounts(rank_file)


def with_prefix_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``prefix_counts``: element i counts the first i code points."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(vocabulary_file("tiktoken"))
        # A count takes as many bytes as four characters do.
        for batch in slices(batches, 1 << 20):
            arrays = [counter.of_text(t).astype(np.int32) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], ["doc_id", "text", "prefix_counts"]
            )

    return id_and_text(docs).mapInArrow(
        count, "doc_id bigint, text string, prefix_counts array<int>"
    )


def tokens_of_prefix(n_chars: Column, counts: Column | str = "prefix_counts") -> Column:
    """Tokens of the first ``n_chars`` code points; 0 for none, null beyond the text."""
    return F.when(n_chars == 0, 0).otherwise(F.try_element_at(counts, n_chars.cast("int")))


def longest_prefix(budget: int, counts: Column | str = "prefix_counts") -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens.

    Counts may fall again (a further letter can merge tokens), so the last one that fits
    is taken. It lies after at most one token's length of larger counts.
    """
    fits = F.transform(counts, lambda c: c <= budget)
    return F.size(counts) + 1 - F.coalesce(
        F.nullif(F.array_position(F.reverse(fits), True), F.lit(0)),
        (F.size(counts) + 1).cast("bigint"),
    )


def count_tokens(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per document ``n_bytes``, ``n_tokens``, ``over_limit`` and ``chars_within_limit``.

    All are read off the table of prefix counts, which is dropped afterwards;
    ``with_prefix_counts`` keeps it.
    """
    columns = (
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean,"
        " chars_within_limit bigint"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(vocabulary_file("tiktoken"))
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            totals, fitting = [], []
            for text in texts:
                counts = counter.of_text(text)
                totals.append(int(counts[-1]) if len(counts) else 0)
                within = np.flatnonzero(counts <= limit)
                fitting.append(int(within[-1]) + 1 if len(within) else 0)
            n_tokens = pa.array(totals, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    n_tokens,
                    pa.array(np.array(totals) > limit),
                    pa.array(fitting, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_within_limit"],
            )

    return id_and_text(docs).mapInArrow(count, columns)
