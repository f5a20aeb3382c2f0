"""Benchmark decontamination with DataFrame functions only.

Benchmark texts are cut into windows of ``WINDOW`` normalised words (a shorter item is
one window), and the distinct windows form a hash set that is broadcast while its bytes
stay below ``BROADCAST_BYTES``; beyond that the same equi join is shuffled. Documents are
scanned once: every window is probed, and since the key is the window's own words, the
probe compares them and a hit needs no second look. Only hits, and one marker row for
each document, are shuffled to put a document's hits together.

Null texts have no words and no hits; items without words match nothing; equal rows are
kept apart and give equal rows; empty tables give no rows or no hits. Columns other than
``doc_id`` and ``text`` (``item_id`` and ``text``) are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.stored import small_side, stored

WINDOW = 10
#: Largest hash set, in bytes of its windows, that may travel to every executor.
BROADCAST_BYTES = 64 << 20
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Lower-case words: ASCII letters and digits, and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _NO_WORD), "")


def _windows(words: Column, size: int) -> Column:
    """Structs (at, size, words joined) for each run of ``size`` words; ``at`` from 1."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1)))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda at: F.struct(
            at.alias("at"),
            F.lit(size).alias("size"),
            F.array_join(F.slice(words, at, size), " ").alias("window"),
        ),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: their words and the items that have them."""
    n = F.size("words")
    sized = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")
    ).select(
        "item_id",
        F.when(
            n >= window, F.transform(_windows(F.col("words"), window), lambda w: w["window"])
        )
        .when(n > 0, F.array(F.array_join("words", " ")))
        .alias("windows"),
        F.least(n, F.lit(window)).alias("size"),
    )
    return (
        sized.select("item_id", "size", F.explode("windows").alias("window"))
        .groupBy("size", "window")
        .agg(F.collect_set("item_id").alias("items"))
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: ``n_words``, ``hits`` (distinct at and size) and the sorted ``items``."""
    known = benchmark_windows(benchmark, window).cache()
    figures = known.agg(
        F.collect_set("size").alias("sizes"),
        F.sum(F.octet_length("window") + 16 * (1 + F.size("items"))).alias("bytes"),
    ).first()
    sizes = sorted(figures["sizes"])  # at most ``window`` different ones
    small = (figures["bytes"] or 0) <= BROADCAST_BYTES
    known = known.select(F.col("window").alias("_window"), F.col("size").alias("_size"), "items")
    words = F.col("words")
    # The marker keeps documents without hits and carries their number of words, so that
    # no row but the scanned one holds the words.
    marker = F.struct(F.lit(0).alias("at"), F.size(words).alias("size"), F.lit("").alias("window"))
    scanned = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id"),
            words_of(F.col("text")).alias("words"),
        )
        .select(
            "row",
            "doc_id",
            F.explode(F.concat(F.array(marker), *(_windows(words, n) for n in sizes))).alias("w"),
        )
        .select("row", "doc_id", "w.*")
    )
    probed = scanned.join(
        F.broadcast(known) if small else known,
        (F.col("window") == F.col("_window")) & (F.col("size") == F.col("_size")),
        "left",
    ).where(F.col("items").isNotNull() | (F.col("at") == 0))
    at_hit = F.col("at") > 0
    return probed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(~at_hit, F.col("size"))).alias("n_words"),
        F.collect_set(F.when(at_hit, F.struct("at", "size"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(at_hit, F.col("items")))))).alias(
            "items"
        ),
    )


def hit_words(hits: Column) -> Column:
    """Numbers of the words inside any hit, from 1, in order."""
    return F.array_sort(
        F.array_distinct(
            F.flatten(
                F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))
            )
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, items found and their digest."""
    n_hit = F.size(hit_words(F.col("hits")))
    return find_hits(docs, benchmark, window).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _by_digest(docs: DataFrame) -> DataFrame:
    """The texts under their own digest, in the place of an id."""
    return docs.select(F.sha2("text", 256).alias("doc_id"), "text")


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, all columns kept.

    Each row is decided by its own text: hits are looked up by the digest of the text, so
    null and repeated ids do not matter. A null text has no hits.
    """
    name = _fresh(docs, "_hit")
    hit = stored(
        find_hits(_by_digest(docs), benchmark, window)
        .where(F.size("hits") > 0)
        .select(F.col("doc_id").alias(name))
        .distinct(),
        "hits",
    )
    return docs.join(small_side(hit), F.sha2(docs["text"], 256) == F.col(name), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, hit words and what separates them cut out of ``text``.

    Each cut leaves one line feed. As in ``remove_documents`` each row is decided by its
    own text.
    """
    name, cuts = _fresh(docs, "_hit"), _fresh(docs, "_cut")
    hits = stored(
        find_hits(_by_digest(docs), benchmark, window)
        .where(F.size("hits") > 0)
        .groupBy(F.col("doc_id").alias(name))
        .agg(F.first(hit_words(F.col("hits"))).alias(cuts)),
        "hits",
    )
    places = F.col(cuts)
    parts, gaps = F.split("text", _NO_WORD), F.regexp_extract_all("text", F.lit(_NO_WORD), F.lit(0))
    lead = F.when(F.element_at(parts, 1) == "", 0).otherwise(1)
    pieces = F.transform(
        parts,
        lambda part, i: F.when(F.array_contains(places, i + lead), "\n").otherwise(
            F.concat(part, F.coalesce(F.get(gaps, i), F.lit("")))
        ),
    )
    cut = F.regexp_replace(F.array_join(pieces, ""), r"\n{2,}", "\n")
    joined = docs.join(hits, F.sha2(docs["text"], 256) == F.col(name), "left")
    return joined.withColumn("text", F.when(places.isNull(), F.col("text")).otherwise(cut)).select(
        *docs.columns
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)
), dw AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(words) >= size)
), hit AS (
  SELECT r, i, dw.size AS size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size
), covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
