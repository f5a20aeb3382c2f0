"""Quality rules as a ledger of bits: measure once, decide many times.

``rule_ledger`` reads every text once and stores its measurements and one bit for each
rule that it fails. A policy is a versioned mask of rules (and how many of them must
fail), so applying another policy, or asking what a rule alone costs, is integer work on
the ledger and never touches a text again.

Null texts have no words. Texts without words fail ``few_words`` only. Equal rows give
equal rows, an empty table gives none, other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.batches import WordHashes, id_and_text, slices, utf8, windows

#: Words of a window that counts as repeated when it is found twice in a text.
WINDOW = 8
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_letters",
)

#: Rules by bit. Each is true where a text fails; integers only, so no rounding decides.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "2 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 2 * n_dup_lines > n_lines",
    "capitals": "n_letters >= 20 and 2 * n_upper > n_letters",
    "long_words": "n_words > 0 and word_chars > 30 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """Reject what fails one of ``always``, or at least ``at_least`` of ``counted``."""

    version: str
    always: tuple[str, ...]
    counted: tuple[str, ...] = ()
    at_least: int = 1

    @staticmethod
    def mask(rules: tuple[str, ...]) -> int:
        return sum(1 << list(RULES).index(r) for r in rules)

    def rejects(self, bits: Column) -> Column:
        """Whether a text with these failure bits goes."""
        counted = F.bit_count(bits.bitwiseAND(F.lit(self.mask(self.counted))))
        return (bits.bitwiseAND(F.lit(self.mask(self.always))) != 0) | (counted >= self.at_least)


BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy(
    "standard-1", ("few_words", "repeated_words", "symbols", "repeated_lines", "capitals", "long_words")
)
LENIENT = Policy(
    "lenient-1", BASE.always, ("symbols", "repeated_lines", "capitals", "long_words"), 2
)


def _measured(text: bytes, n_chars: int, hashes: WordHashes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    found = windows(hashes.of(words), WINDOW) if len(words) >= WINDOW else np.empty(0, np.uint64)
    repeated = 0
    if len(found):
        order = np.argsort(found, kind="stable")
        same = found[order][1:] == found[order][:-1]
        if same.any():
            twice = np.zeros(len(found), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            edges = np.zeros(len(words) + 1, np.int32)
            at = np.flatnonzero(twice)
            edges[at] += 1
            edges[at + WINDOW] -= 1
            repeated = int((np.cumsum(edges) > 0).sum())
    return (
        len(words),
        len(joined) - (len(text) - n_chars),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        len(text) - len(text.translate(None, _UPPER)),
        len(text) - len(text.translate(None, _LETTERS)),
    )


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of its whole text; a batch of texts at a time.

    Two windows count as equal when their 64-bit hashes are.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            texts = batch.column(1)
            rows = [
                _measured(raw, len(text), hashes)
                for raw, text in zip(utf8(texts), texts.to_pylist(), strict=True)
            ]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *MEASURES])

    schema = ", ".join(["doc_id bigint", *(f"{m} bigint" for m in MEASURES)])
    return id_and_text(docs).mapInArrow(measure, schema)


def rule_ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set where rule i fails."""
    bits = reduce(
        Column.bitwiseOR,
        (
            F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            for i, rule in enumerate(RULES.values())
        ),
    )
    return measures(docs).withColumn("fail_bits", bits)


def apply_policies(ledger: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """Add a column ``kept_<version>`` for each policy."""
    return ledger.withColumns({f"kept_{p.version}": ~p.rejects(F.col("fail_bits")) for p in policies})


def ablations(ledger: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """Per policy and rule: texts that fail the rule, that go, and that would stay without it.

    The ledger is first counted by its bits: at most 2^rules rows, whatever its size.
    """
    by_bits = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    bits = F.col("fail_bits")
    rows = []
    for policy in policies:
        for name in (*policy.always, *policy.counted):
            one = F.lit(Policy.mask((name,)))
            without = bits.bitwiseAND(F.bitwise_not(one))
            goes = policy.rejects(bits)
            rows.append(
                F.struct(
                    F.lit(policy.version).alias("policy"),
                    F.lit(name).alias("rule"),
                    (bits.bitwiseAND(one) != 0).alias("fails"),
                    goes.alias("goes"),
                    (goes & ~policy.rejects(without)).alias("alone"),
                )
            )
    return (
        by_bits.select("n", F.inline(F.array(*rows)))
        .groupBy("policy", "rule")
        .agg(
            *(
                F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(f"n_{c}")
                for c in ("fails", "goes", "alone")
            )
        )
    )


def apply_rules(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``, the verdict of ``policy``."""
    base = BASE.rejects(F.col("fail_bits"))
    return rule_ledger(docs).select(
        "doc_id",
        *MEASURES,
        "fail_bits",
        base.alias("base_failed"),
        (~base & ~policy.rejects(F.col("fail_bits"))).alias("kept"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, r, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), win AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters
  FROM w LEFT JOIN covered ON covered.r = w.r
), bits AS (
  SELECT *, CAST(
    (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN n_letters >= 20 AND 2 * n_upper > n_letters THEN 16 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND word_chars > 30 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM bits
"""
