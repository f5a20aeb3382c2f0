"""Exact n-gram Jaccard join by partition-and-enumerate signatures.

Sets of word shingles with ``100 * |A & B| >= 75 * |A | B|`` differ in at most
``(|A| + |B|) / 7`` elements. The domain of shingles is cut into partitions by hash, as
many as the band of set sizes asks for; k differing elements spoil at most k partitions,
so in all others two linked sets look the same. What a set has in one partition is one
signature.

Not all signatures are needed. Order the partitions of a set by a rule that looks at
nothing but the signature: if k can differ, the k + 1 first of both sets still have one
in common (their shared signature that comes first). The rule puts signatures of common
shingles alone last (a fixed-size bit map that is filled by all documents says which are
common), then those of few shingles, so that the ones kept are rare. Empty partitions
come at the very end and are only used by sets with too few others.

Sets whose sizes differ too much never meet: bands have a ratio of 8, and a set close
above the lower end of its band also signs for the band below.

Equal sets are one class from the start. Classes that share a signature are first
compared with leaders of the group only: those with most signatures in common with others
(copies with few changes of their own), then some drawn by hash, each class with the few
leaders it shares most signatures with. Verified pairs give components, and only pairs
whose components still differ are compared at last. A pair that shares many signatures is
made at the first of them only: every set knows its smallest ``FIRST`` signatures, and a
pair is left to a smaller one that both know. Before texts are read, an exact lower bound
of the difference drops pairs: the parities of the numbers of shingles in buckets, at least
four for each shingle; 512 such parities are in the condition of the last join.
Verification counts shared shingles of the whole texts (64-bit hashes).

Null and empty texts have no shingles and are alone. Texts of fewer words than a shingle
are one shingle. Repeated rows fall into the same class. An empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from corridor.llm.batches import WordHashes, id_and_text, mixed, slices, utf8, windows
from corridor.llm.stored import components, small_side, stored

SHINGLE = 5
BAND = 8
#: Parities known in the last join, and the most that a set's sketch holds.
PARITIES, MOST_PARITIES = 512, 1 << 17
#: Smallest signatures that a set knows of itself when pairs are made.
FIRST = 8
#: Leaders drawn by hash in the second round, and leaders a class is compared with.
DRAWN, PARTNERS = 4, (2, 4)
#: Bits of the map of common shingles.
COMMON_BITS = 1 << 23
#: Shingles a task looks at before it reports the common ones among them, and how often
#: one must occur there.
COMMON_WINDOW = 2_000_000
COMMON_COUNT = 4
#: Shingles of the sets a task remembers while it verifies pairs.
KEPT = 4_000_000
#: Set ids a task remembers so as not to sign for copies again.
SEEN = 1_000_000


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes.of(words), min(SHINGLE, len(words))))


def set_id(found: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    return int(np.uint64(xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in buckets, four or more for each, as bytes."""
    n = min(MOST_PARITIES, max(PARITIES, 1 << (4 * len(found)).bit_length()))
    at = ((found >> np.uint64(24)) % np.uint64(n)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=n) & 1).astype(bool))


def folded(sketched: np.ndarray, n_bytes: int) -> np.ndarray:
    """The parities of fewer, wider buckets."""
    return np.bitwise_xor.reduce(sketched.reshape(-1, n_bytes), axis=0)


def least_apart(x: np.ndarray, y: np.ndarray) -> int:
    """Elements in which the sets of two sketches differ at least."""
    n_bytes = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, n_bytes) ^ folded(y, n_bytes)).sum())


def most_differing(size: int) -> int:
    """Elements in which a set of ``size`` can differ from one it is linked with."""
    return (size + 4 * size // 3) // 7


def bands(size: int) -> list[int]:
    """Upper ends of the bands a set signs for."""
    low = 1
    while low * BAND <= size:
        low *= BAND
    own = [low * BAND]
    return own + [low] if low > 1 and 3 * size < 4 * low else own


def signatures(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The signatures a set needs to share one with every set it is linked with."""
    need = most_differing(len(found)) + 1
    spread = mixed(found + np.uint64(1))
    is_common = common[(found % np.uint64(COMMON_BITS)).astype(np.int64)]
    out = []
    for top in bands(len(found)):
        n_parts = max(16, top // 2)
        part = spread % np.uint64(n_parts)
        order = np.argsort(part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums = np.add.reduceat(mixed(found + np.uint64(2))[order], starts)
        sizes = np.diff(np.append(starts, len(part)))
        base = np.uint64(top) << np.uint64(32)
        names = mixed(sums ^ mixed(part[starts] + base))
        if len(names) > need:
            all_common = np.logical_and.reduceat(is_common[order], starts)
            rank = (
                (all_common.astype(np.uint64) << np.uint64(63))
                | ((63 - np.minimum(sizes, 63)).astype(np.uint64) << np.uint64(57))
                | (names >> np.uint64(7))
            )
            names = names[np.argpartition(rank, need - 1)[:need]]
        elif len(names) < need:
            empty = np.setdiff1d(np.arange(n_parts, dtype=np.uint64), part)
            names = np.concatenate((names, mixed(mixed(empty + base))[: need - len(names)]))
        out.append(names)
    return np.concatenate(out)


def _features(docs: DataFrame) -> DataFrame:
    """Per document its set's size, name and parities; extra rows list common shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, n_waiting = WordHashes(), [], 0

        def common() -> list[int]:
            values, counts = np.unique(np.concatenate(waiting), return_counts=True)
            values = values[counts >= COMMON_COUNT] % np.uint64(COMMON_BITS)
            return np.unique(values).astype(np.int32).tolist()

        def out(ids, sizes, names, sketches, parities, listed) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(sketches, pa.binary()),
                    pa.array(parities, pa.list_(pa.int64())),
                    pa.array(listed, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_shingles", "set_id", "sketch", "parities", "common"],
            )

        for batch in slices(batches):
            sizes, names, sketches, parities = [], [], [], []
            for text in utf8(batch.column(1)):
                found = shingles(text, hashes)
                sizes.append(len(found))
                names.append(set_id(found) if len(found) else None)
                odd = sketch(found)
                sketches.append(odd.tobytes())
                parities.append(folded(odd, PARITIES // 8).view(np.int64))
                waiting.append(found)
                n_waiting += len(found)
            ids = batch.column(0).to_pylist()
            yield out(ids, sizes, names, sketches, parities, [None] * len(sizes))
            if n_waiting >= COMMON_WINDOW:
                yield out([None], [None], [None], [None], [None], [common()])
                waiting, n_waiting = [], 0
        if waiting:
            yield out([None], [None], [None], [None], [None], [common()])

    return id_and_text(docs).mapInArrow(
        run,
        "doc_id bigint, n_shingles bigint, set_id bigint, sketch binary,"
        " parities array<bigint>, common array<int>",
    )


def _bit_map(features: DataFrame) -> np.ndarray:
    """The map of common shingles: as large for any input."""
    words = (
        features.where(F.col("common").isNotNull())
        .select(F.explode("common").alias("bit"))
        .groupBy((F.col("bit") / 32).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("bits"))
        .toPandas()
    )
    whole = np.zeros(COMMON_BITS // 32, np.uint32)
    whole[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(whole.astype("<u4").view(np.uint8), bitorder="little").astype(bool)


def _signed(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Rows (signature, set): one for each signature of each set."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        known = np.unpackbits(shared.value).astype(bool)
        for batch in slices(batches):
            signed, owners, sizes = [], [], []
            for text in utf8(batch.column(1)):
                found = shingles(text, hashes)
                if not len(found) or (name := set_id(found)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                signed.append(signatures(found, known))
                owners.append(name)
                sizes.append(len(found))
            if signed:
                times = [len(s) for s in signed]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(signed).view(np.int64)),
                        pa.array(np.repeat(np.array(owners, np.int64), times)),
                        pa.array(np.repeat(np.array(sizes, np.int32), times)),
                    ],
                    ["signature", "set_id", "size"],
                )

    return docs.mapInArrow(run, "signature bigint, set_id bigint, size int")


def _close(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) that their sizes and sketches do not rule out."""
    known = stored(pairs.select(F.explode(F.array("a", "b")).alias("_known")).distinct(), "known")
    side = classes.join(small_side(known), F.col("set_id") == F.col("_known"), "left_semi").select(
        "set_id", "size", "doc", "sketch"
    )
    a, b = (side.select(*(F.col(c).alias(f"{c}_{x}") for c in side.columns)) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(f"sketch_{s}") for s in "ab")
            most = np.add(*(batch.column(f"size_{s}").to_numpy() for s in "ab")) // 7
            apart = [
                least_apart(*(np.frombuffer(c[i].as_buffer(), np.uint8) for c in (x, y)))
                for i in range(batch.num_rows)
            ]
            kept = batch.filter(pa.array(np.array(apart, np.int64) <= most, pa.bool_()))
            yield kept.select(["a", "b", "doc_a", "doc_b"])

    return (
        pairs.join(a, F.col("a") == F.col("set_id_a"))
        .join(b, F.col("b") == F.col("set_id_b"))
        .where(_sizes_fit("size_a", "size_b"))
        .select("a", "b", "doc_a", "doc_b", "size_a", "size_b", "sketch_a", "sketch_b")
        .mapInArrow(run, "a bigint, b bigint, doc_a bigint, doc_b bigint")
    )


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) of set ids that are linked."""
    close = stored(_close(pairs, classes), "close")
    needed = stored(
        close.select(F.explode(F.array("doc_a", "doc_b")).alias("doc_id")).distinct(), "needed"
    )
    texts = docs.join(small_side(needed), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept, n_kept = WordHashes(), {}, 0

        def of(text: str, name: int) -> np.ndarray | None:
            """The set called ``name``, unless this text, with the same ``doc_id``, has another."""
            nonlocal n_kept
            if name not in kept:
                found = shingles(text.encode(), hashes)
                if set_id(found) != name:
                    return None
                if n_kept + len(found) > KEPT:
                    kept.clear()
                    n_kept = 0
                kept[name] = found
                n_kept += len(found)
            return kept[name]

        for batch in slices(batches):
            linked = []
            columns = batch.to_pydict()
            for a_id, b_id, a_text, b_text in zip(
                columns["a"], columns["b"], columns["text_a"], columns["text_b"], strict=True
            ):
                x, y = of(b_text, b_id), of(a_text, a_id)
                if x is None or y is None:
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= 75 * (len(x) + len(y) - shared):
                    linked.append((a_id, b_id))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in linked], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    with_texts = (
        close.join(texts.select(F.col("doc_id").alias("doc_a"), F.col("text").alias("text_a")), "doc_a")
        .join(texts.select(F.col("doc_id").alias("doc_b"), F.col("text").alias("text_b")), "doc_b")
        .select("a", "b", "text_a", "text_b")
    )
    return with_texts.mapInArrow(run, "a bigint, b bigint")


def _sizes_fit(a: str, b: str) -> Column:
    return (4 * F.col(a) >= 3 * F.col(b)) & (4 * F.col(b) >= 3 * F.col(a))


def _same() -> WindowSpec:
    return Window.partitionBy("signature")


def _open_groups(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their components, of the groups that have more than one component."""
    return (
        groups.join(small_side(found), F.col("set_id") == F.col("node"), "left")
        .select("signature", "set_id", "size", F.coalesce("component", "set_id").alias("component"))
        .withColumns({"low": F.min("component").over(_same()), "high": F.max("component").over(_same())})
        .where(F.col("low") != F.col("high"))
        .drop("low", "high")
    )


def _with_leaders(groups: DataFrame, orders: list[Column], partners: int) -> DataFrame:
    """Pairs (a, b) of each set with the leaders of its groups it shares most groups with.

    A group has one leader for each order, the member that has the largest value.
    """
    tops = [F.max(F.struct(o.alias("o"), "set_id", "component")).over(_same()) for o in orders]
    ranked = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    return (
        groups.withColumn("tops", F.array(*tops))
        .select("set_id", "component", F.explode("tops").alias("top"))
        .where(F.col("component") != F.col("top.component"))
        .groupBy(F.col("set_id").alias("a"), F.col("top.set_id").alias("b"))
        .agg(F.count("*").alias("n"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= partners)
        .select("a", "b")
    )


def _meetings(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets in one group, of different components, that may be linked.

    The parities are part of the join's condition, so a pair whose known difference is too
    large for a link is no row, neither shuffled nor written. So are the first signatures:
    a pair that shares one of them below the group's own is a row of that group instead.
    The smallest signature that two sets share is never left out.
    """
    odd = [f"odd{i}" for i in range(PARITIES // 64)]
    known = classes.select("set_id", *(F.col("parities")[i].alias(c) for i, c in enumerate(odd)))
    smallest = Window.partitionBy("set_id").orderBy("signature")
    first = (
        groups.select("set_id", "signature", F.row_number().over(smallest).alias("_at"))
        .where(F.col("_at") <= FIRST)
        .groupBy("set_id")
        .agg(F.collect_list("signature").alias("first"))
    )
    members = groups.join(first.join(known, "set_id"), "set_id").withColumn(
        "earlier", F.filter("first", lambda s: s < F.col("signature"))
    )
    x, y = (
        members.select(
            "signature", *(F.col(c).alias(f"{c}_{s}") for c in ("set_id", "size", "component", "earlier", *odd))
        )
        for s in "xy"
    )
    apart = reduce(add, (F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in odd))
    return (
        x.join(y, "signature")
        .where(
            (F.col("component_x") < F.col("component_y"))
            & _sizes_fit("size_x", "size_y")
            & (7 * apart <= F.col("size_x") + F.col("size_y"))
            & ~F.arrays_overlap("earlier_x", "earlier_y")
        )
        .select(F.col("set_id_x").alias("a"), F.col("set_id_y").alias("b"))
    )


def _across(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of ``_meetings``, each once."""
    return _meetings(groups, classes).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per document ``n_shingles`` and ``component_id``, the smallest ``doc_id`` it is linked with."""
    docs = id_and_text(docs)
    features = stored(_features(docs), "features")
    of_docs = features.where(F.col("n_shingles").isNotNull()).drop("common")
    classes = of_docs.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min("doc_id").alias("doc"),
        F.min("n_shingles").cast("int").alias("size"),
        F.min("sketch").alias("sketch"),
        F.min("parities").alias("parities"),
    )
    classes = stored(classes, "classes")
    signed = _signed(docs, _bit_map(features))
    groups = stored(
        signed.withColumns(
            {"low": F.min("set_id").over(_same()), "high": F.max("set_id").over(_same())}
        )
        .where(F.col("low") != F.col("high"))
        .select("signature", "set_id", "size")
        .distinct(),
        "groups",
    )
    weights = stored(
        groups.groupBy(F.col("set_id").alias("_set")).agg(F.count("*").alias("weight")), "weights"
    )
    weighed = groups.join(small_side(weights), F.col("set_id") == F.col("_set")).select(
        "signature", "set_id", F.col("set_id").alias("component"), "weight"
    )
    best = stored(_with_leaders(weighed, [F.col("weight")], PARTNERS[0]), "pairs")
    linked = stored(_verified(docs, best, classes), "linked")
    found = stored(components(linked), "components")
    drawn = [F.xxhash64("set_id", F.lit(i)) for i in range(DRAWN)]
    best = stored(_with_leaders(_open_groups(groups, found), drawn, PARTNERS[1]), "pairs")
    linked = linked.union(stored(_verified(docs, best, classes), "linked"))
    found = stored(components(linked), "components")
    mixed_groups = stored(_open_groups(groups, found), "open")
    across = stored(_across(mixed_groups, classes), "across")
    linked = linked.union(stored(_verified(docs, across, classes), "linked"))
    found = stored(components(linked), "components")
    placed = classes.join(found, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "doc", F.coalesce("component", "set_id").alias("component")
    )
    smallest = placed.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_set = placed.join(smallest, "component").select(
        F.col("set_id").alias("_set"), "component_id"
    )
    return of_docs.join(by_set, F.col("set_id") == F.col("_set"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each component the smallest ``doc_id`` stays.

    Rows with the same ``doc_id`` and text count as one. Rows without ``doc_id`` count as
    later than all others, each by itself; theirs stays null. All columns are kept.
    """
    unnamed = docs.where(F.col("doc_id").isNull())
    if unnamed.isEmpty():
        return _one_of_each(docs)
    largest = docs.agg(F.max("doc_id").cast("bigint")).first()[0] or 0
    # Numbered once and stored, so that the numbers hold for all that follows.
    later = (F.lit(largest) + 1 + F.monotonically_increasing_id()).cast("bigint")
    numbered = stored(unnamed.withColumn("doc_id", later), "numbered")
    kept = _one_of_each(docs.where(F.col("doc_id").isNotNull()).unionByName(numbered))
    return kept.withColumn("doc_id", F.when(F.col("doc_id") <= largest, F.col("doc_id")))


def _one_of_each(docs: DataFrame) -> DataFrame:
    found = stored(jaccard_components(docs), "components")
    away = stored(
        found.where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias("_away"))
        .distinct(),
        "away",
    )
    again = stored(
        found.groupBy(F.col("doc_id").alias("_again")).count().where("count > 1"), "again"
    )
    away, again = small_side(away), small_side(again)
    kept = docs.join(away, docs["doc_id"] == away["_away"], "left_anti")
    repeated = docs["doc_id"] == again["_again"]
    return kept.join(again, repeated, "left_anti").unionByName(
        kept.join(again, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM d WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM met JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""
