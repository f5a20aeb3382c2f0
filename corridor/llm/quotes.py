"""Quotation linking with DataFrame functions only.

Messages are cut into lines. The marks in front of a line (``>``, nested) give its quote
level; the rest is normalised and hashed. A quoted line is joined to the latest earlier
message of its conversation that has the same line as its own words. A line without
marks that repeats at least ``REPEATED_WORDS`` words of an earlier message counts as an
unmarked quote. A message replies to the message that most of its outermost quoted lines
come from (the later one on ties), else to the one before it. Conversations ordered by
``turn`` are then reply-ordered, since every message follows the one it replies to.

"The latest earlier" is found without pairing rows: within ranges of ``RANGE`` turns of a
conversation and line, plus the maximum carried over from the ranges before. So neither a
long conversation nor a line that everybody repeats meets in one task.

A null text counts as empty and stays a message without text. Rows with the same
conversation and turn do not see each other; null turns neither reply nor are replied
to; null conversations are one conversation. Repeated rows stay. Other columns are not
read. Messages that are quotes alone keep an empty text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPEATED_WORDS = 6
RANGE = 1024
_MARKS = r"^[ \t]*(?:>[ \t]?)+"
#: Lines that introduce a quote (in the languages of the texts).
_INTRODUCES = r"^(?:On|Am|Le|El) .*(?:wrote|schrieb.*|a écrit|escribió) ?:$"


def _latest_before(rows: DataFrame, keys: Sequence[str], offered: Column, name: str) -> DataFrame:
    """Add the largest ``turn`` below the row's own among rows that are ``offered``, per key."""
    turn = F.col("turn")
    ranged = rows.withColumn("_range", F.floor(turn / RANGE)).withColumn(
        "_offer", F.when(offered, turn)
    )
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy("turn")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    before = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        ranged.where(turn.isNotNull())
        .groupBy(*keys, "_range")
        .agg(F.max("_offer").alias("_last"))
        .withColumn("_carried", F.max("_last").over(before))
        .where(F.col("_carried").isNotNull())
        .select(*(F.col(k).alias(f"_{k}") for k in (*keys, "_range")), "_carried")
    )
    near = ranged.withColumn("_near", F.when(turn.isNotNull(), F.max("_offer").over(inside)))
    same = reduce(
        lambda a, b: a & b, (near[k].eqNullSafe(carried[f"_{k}"]) for k in (*keys, "_range"))
    )
    found = F.coalesce("_near", "_carried").alias(name)
    return near.join(carried, same, "left").select(*rows.columns, found)


def quote_lines(messages: DataFrame) -> DataFrame:
    """One row per line: its message, number, quote level, text without marks and hash.

    Hashes are null for lines that cannot link: empty ones and lines that introduce a quote.
    """
    line = F.col("line")
    body = F.regexp_replace(line, _MARKS, "")
    normal = F.lower(F.trim(F.regexp_replace("body", r"[ \t\r]+", " ")))
    marks = F.regexp_extract(line, _MARKS, 0)
    return (
        messages.select(
            "row", "conv_id", "turn", F.posexplode(F.split(F.col("text"), "\n")).alias("at", "line")
        )
        .withColumns({"level": F.length(F.regexp_replace(marks, "[^>]", "")), "body": body})
        .withColumn("normal", normal)
        .select(
            "row",
            "conv_id",
            "turn",
            "at",
            "level",
            "body",
            F.when((F.col("normal") != "") & ~F.col("body").rlike(_INTRODUCES), F.xxhash64("normal")).alias("hash"),
            F.size(F.split("normal", " ")).alias("n_words"),
        )
    )


def link_quotes(conversations: DataFrame, repeated_words: int = REPEATED_WORDS) -> DataFrame:
    """One row per message: what it replies to (-1: nothing), its quotes, its text without them."""
    messages = conversations.select(
        F.monotonically_increasing_id().alias("row"),
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    own = F.col("level") == 0
    lines = quote_lines(messages)
    linked = _latest_before(
        lines.where(F.col("hash").isNotNull()), ["conv_id", "hash"], own, "origin"
    ).unionByName(lines.where(F.col("hash").isNull()).withColumn("origin", F.lit(None).cast("bigint")))
    unmarked = own & F.col("origin").isNotNull() & (F.col("n_words") >= repeated_words)
    told = linked.withColumn("level", F.when(unmarked, 1).otherwise(F.col("level")))
    quoted = F.col("level") > 0
    kept = F.when(
        ~quoted & ~F.col("body").rlike(_INTRODUCES), F.struct(F.col("at"), F.col("body"))
    )
    texts = told.groupBy("row").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["body"]), "\n"
        ).alias("text"),
        F.count_if(quoted).alias("n_quoted"),
        F.count_if(quoted & F.col("origin").isNotNull()).alias("n_linked"),
        F.max("level").cast("int").alias("max_level"),
    )
    # Lines of the outermost quotes vote for the message they come from.
    voted = (
        told.where(quoted & F.col("origin").isNotNull())
        .groupBy("row", "level", "origin")
        .agg(F.count("*").alias("n"))
        .groupBy("row")
        .agg(F.min(F.struct("level", -F.col("n"), -F.col("origin"))).alias("best"))
        .select(F.col("row").alias("_row"), (-F.col("best.col3")).alias("source"))
    )
    placed = _latest_before(
        messages.drop("text"), ["conv_id"], F.lit(True), "previous"
    )
    return (
        placed.join(texts, "row")
        .join(voted, F.col("row") == F.col("_row"), "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.coalesce("source", "previous", F.lit(-1)).alias("reply_to"),
            F.when(F.col("source").isNotNull(), "quote")
            .when(F.col("previous").isNotNull(), "order")
            .alias("linked_by"),
            "max_level",
            "n_quoted",
            "n_linked",
            F.trim(F.col("text")).alias("text"),
        )
    )


ORACLE = rf"""
WITH m AS (
  SELECT row_number() OVER () AS r, conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS text
  FROM conversations
), l AS (
  SELECT r, conv_id, turn, pos, length(regexp_replace(regexp_extract(line, '{_MARKS}'), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '{_MARKS}', '') AS body,
    lower(trim(regexp_replace(regexp_replace(line, '{_MARKS}', ''), '[ \t\r]+', ' ', 'g'))) AS normal
  FROM (SELECT r, conv_id, turn, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
               unnest(string_split(text, chr(10))) AS line FROM m)
), h AS (
  SELECT *, normal <> '' AND NOT regexp_matches(body, '{_INTRODUCES}') AS links FROM l
), o AS (
  SELECT h.*, (SELECT max(e.turn) FROM h e WHERE e.conv_id IS NOT DISTINCT FROM h.conv_id
    AND e.normal = h.normal AND e.turn < h.turn AND e.level = 0 AND e.links AND h.links) AS origin FROM h
), t AS (
  SELECT r, pos, body, links, origin, CASE WHEN level = 0 AND origin IS NOT NULL
    AND len(string_split(normal, ' ')) >= {REPEATED_WORDS} THEN 1 ELSE level END AS level FROM o
), s AS (
  SELECT r, coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (
      WHERE level = 0 AND NOT regexp_matches(body, '{_INTRODUCES}')), '') AS text,
    count(*) FILTER (WHERE level > 0) AS n_quoted,
    count(*) FILTER (WHERE level > 0 AND origin IS NOT NULL) AS n_linked, max(level)::INT AS max_level
  FROM t GROUP BY r
), v AS (
  SELECT r, origin AS source FROM (
    SELECT r, level, origin, count(*) AS n FROM t WHERE level > 0 AND origin IS NOT NULL GROUP BY ALL
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY level, n DESC, origin DESC) = 1
), p AS (
  SELECT r, max(turn) OVER (PARTITION BY conv_id ORDER BY turn
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM m
)
SELECT conv_id, turn, role, coalesce(source, previous, -1) AS reply_to,
  CASE WHEN source IS NOT NULL THEN 'quote' WHEN previous IS NOT NULL THEN 'order' END AS linked_by,
  max_level, n_quoted, n_linked, trim(s.text) AS text
FROM m JOIN s USING (r) JOIN p USING (r) LEFT JOIN v USING (r)
"""
