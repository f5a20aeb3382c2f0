"""Long texts in proportion, clashing names, rows without an id or with a shared one."""

import collections
import random
import string
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from corridor.llm import brown, byte_cnn, decontamination, partenum, secrets, toxic_segments
from corridor.llm.batches import ready
from corridor.llm.stored import stored

BENCH = "bench passage one two three four five six seven eight nine ten tail"


def test_many_hits_take_linear_time():
    """Clean texts have falling totals: no candidate is ever joined to an earlier one."""
    seconds = []
    for n in (100_000, 200_000):
        scores = [(10 * i, 0.5) for i in range(n)]
        start = time.perf_counter()
        found = toxic_segments.maximal_segments(scores, 0.1)
        seconds.append(time.perf_counter() - start)
        assert len(found) == n
    assert seconds[1] < 5 and seconds[1] < 4 * seconds[0] + 0.2


@pytest.mark.parametrize("seed", range(4))
def test_long_mixed_scores_equal_the_plain_search(seed):
    """The same candidates as walking back over all of them."""
    rng = random.Random(seed)
    scores = [(i, rng.choice((-1, 1, 1)) * rng.random()) for i in range(3000) if rng.random() < 0.6]
    kept, total, at = [], 0.0, 0
    for place, score in scores:
        total -= 0.2 * (place - at)
        at = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        new = (place, place + 1, before, total)
        while True:
            lower = [k for k, c in enumerate(kept) if c[2] < new[2]]
            if not lower or kept[lower[-1]][3] >= new[3]:
                break
            k = lower[-1]
            new = (kept[k][0], new[1], kept[k][2], new[3])
            del kept[k:]
        kept.append(new)
    got = toxic_segments.maximal_segments(scores, 0.2)
    assert [(s.start, s.end) for s in got] == [c[:2] for c in kept]


def test_a_long_random_string_takes_seconds(spark):
    rng = random.Random(5)
    value = "".join(rng.choices(string.ascii_letters + string.digits, k=30_000))
    # A row that is compiled and run first, so that only the string is timed.
    docs = ready(spark).createDataFrame([(1, "see " + value[:300]), (2, "see " + value + " end")], "doc_id int, text string")
    secrets.scan_secrets(docs.where("doc_id = 1")).collect()
    start = time.perf_counter()
    (row,) = secrets.scan_secrets(docs.where("doc_id = 2")).collect()
    assert time.perf_counter() - start < 60
    cls = next(c for c in secrets.ENTROPY if c.kind == "entropy_base64")
    hot = []
    for i in range(len(value) - cls.window + 1):
        counts = collections.Counter(value[i : i + cls.window]).values()
        if sum(cls.table[n] for n in counts) <= cls.most:
            hot.append(i)
    assert f"entropy_base64:{4 + hot[0]}:{4 + hot[-1] + cls.window}" in row["spans"].split(",")


def test_masking_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "secret: abcdef123456 x", "mine", 7)], "doc_id int, text string, base string, Added int"
    )
    (row,) = secrets.mask_secrets(docs).collect()
    assert tuple(row) == (1, "<secret> x", "mine", 7)
    with pytest.raises(ValueError, match="base"):
        secrets.find_secrets(docs)


@pytest.fixture(scope="module")
def shared(spark):
    rows = [
        (None, BENCH, 1),
        (2, "a clean text of its own", 2),
        (2, BENCH, 3),
        (None, "another clean text", 4),
        (3, None, 5),
        (4, "", 6),
        (5, BENCH, 7),
        (5, BENCH, 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _hit int")
    benchmark = spark.createDataFrame([("b", BENCH.removeprefix("bench passage "))], "item_id string, text string")
    return docs, benchmark


def test_documents_are_removed_row_by_row(shared):
    left = decontamination.remove_documents(*shared).collect()
    assert sorted(r["_hit"] for r in left) == [2, 4, 5, 6]


def test_spans_are_removed_row_by_row(shared):
    docs, benchmark = shared
    got = {r["_hit"]: r["text"] for r in decontamination.remove_spans(docs, benchmark).collect()}
    cut = "bench passage \n"
    assert got == {
        1: cut, 2: "a clean text of its own", 3: cut, 4: "another clean text", 5: None, 6: "", 7: cut, 8: cut
    }
    assert decontamination.remove_spans(docs, benchmark).columns == docs.columns


def test_labels_beyond_0_and_1_are_left_out(spark):
    docs = spark.createDataFrame(
        [(i, f"word{i % 2} text number {i} " + "bad " * (i % 2)) for i in range(80)], "doc_id bigint, text string"
    )
    rows = [(i, [0, 1, 2, -1, None][i % 5], i % 3) for i in range(80)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    texts, found = byte_cnn.training_rows(docs, labels, "quality")
    assert len(texts) == len(found) and set(found.tolist()) <= {0, 1}
    assert byte_cnn.classify(docs, labels).count() == 80
    assert toxic_segments.classify(docs, labels).count() == 80
    only_other = labels.withColumn("toxic", F.lit(7)).withColumn("quality", F.lit(7))
    assert {r["score"] for r in byte_cnn.classify(docs, only_other).collect()} == {0.5}
    assert toxic_segments.classify(docs, only_other).where("score > 0.01").count() == 0


def test_tallies_hand_on_what_no_longer_fits(monkeypatch):
    monkeypatch.setattr(brown, "TALLY_KEYS", 50)
    rng = np.random.default_rng(1)
    tally, seen, parts = brown._Tally(), collections.Counter(), 0
    for _ in range(40):
        keys = rng.integers(0, 200, 30)
        seen.update(keys.tolist())
        for found, counts in tally.add(keys):
            seen.subtract(dict(zip(found.tolist(), counts.tolist())))
            parts += 1
        assert tally.size <= 50 + 30
    for found, counts in tally.rest():
        seen.subtract(dict(zip(found.tolist(), counts.tolist())))
    assert parts > 3 and not any(seen.values()) and list(tally.rest()) == []


def test_copies_without_an_id_are_removed_too(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = text.replace("w39", "changed")
    other = " ".join(f"v{i}" for i in range(40))
    rows = [
        (None, text, 1), (7, near, 2), (None, text, 3), (-5, "short one", 4), (None, other, 5),
        (None, other, 6), (None, other + " more", 7), (None, None, 8), (None, "", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int").repartition(3)
    kept = {r["row"]: r["doc_id"] for r in partenum.one_of_each(docs).collect()}
    assert kept.pop(2) == 7 and kept.pop(4) == -5
    assert len(kept) == 3 and {8, 9} < set(kept) and set(kept) & {5, 6, 7}
    assert set(kept.values()) == {None}


def test_brown_scores_do_not_depend_on_the_pieces_of_a_block(spark, monkeypatch):
    """A block is worked on in pieces of bounded size, documents stay whole."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 30, rng.integers(0, 60))) for _ in range(200)]
    counts = collections.Counter(" ".join(texts).split())
    words = sorted(counts)
    lengths = np.array([len(t.split()) for t in texts])
    at = {w: i for i, w in enumerate(words)}
    row = {
        "tokens": brown._planes(np.array([at[w] for t in texts for w in t.split()], np.int32)),
        "lengths": lengths,
        "held_out": np.arange(200) % 7 == 2,
        "words": np.arange(len(words), dtype=np.int64),
        "entries": np.array(
            [(i, counts[w], i % 4, 0) for i, w in enumerate(words) if i not in (3, 5)], brown._ENTRY
        ),
        "doc_ids": list(range(200)),
    }
    classes = brown.Classes(np.array([3, 5], np.uint64), np.array([1, 0]), np.array([9, 8]))
    (whole,) = brown._class_rows(row, classes)
    monkeypatch.setattr(brown, "PIECE", 100)
    pieces = list(brown._class_rows(row, classes))
    assert max(len(p[0]) for p in pieces) <= 100 and len(pieces) > 20
    for i in (0, 1, 2, 3, 6, 7):
        assert np.array_equal(np.concatenate([p[i] for p in pieces]), whole[i])
    starts = np.cumsum([0, *(len(p[0]) for p in pieces[:-1])])
    assert np.array_equal(np.concatenate([p[5] + s for p, s in zip(pieces, starts)]), whole[5])


def test_brown_gives_rare_words_the_best_class_too(spark, monkeypatch):
    """Words below the share of the exchange are placed by all their neighbours in all blocks."""
    monkeypatch.setattr(brown, "FREQUENT", 20)
    monkeypatch.setattr(brown, "BLOCK", 1500)
    rng = np.random.default_rng(3)
    texts = []
    for i in range(300):
        a, b = (("x", "y") if rng.random() < 0.5 else ("p", "q"))
        texts.append((i, " ".join(f"{a} m{a} {b} {a} {a}{rng.integers(40)} {b}" for _ in range(5)) + ("" if i else " once")))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    first = stored(brown._blocks(docs), "blocks")
    n_tokens = first.agg(F.sum("n_learnt")).first()[0]
    learnt = [t for d, t in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    assert n_tokens == sum(len(t.split()) + 1 for t in learnt)
    counts = collections.Counter(w for t in learnt for w in t.split())
    found = brown.exchange(first, n_tokens)
    frequent = {w for w, c in counts.items() if c * 20 >= n_tokens}
    assert len(found.frequent) == len(frequent) == 6 and sorted(found.counts) == sorted(counts[w] for w in frequent)
    bigrams = brown._bigrams(brown._statistics(first, found, False).where("number = -1").collect())
    of = dict(zip(found.frequent.tolist(), found.of.tolist()))
    number = lambda w: xxh3_64_intdigest(w.encode())
    cell = lambda w: brown.END if w is None else of.get(number(w), brown.REST)
    around = collections.defaultdict(lambda: np.zeros(2 * brown.N_CLASSES))
    for t in learnt:
        words = t.split()
        for w, before, after in zip(words, [None, *words], [*words[1:], None]):
            around[w][cell(before)] += 1
            around[w][brown.N_CLASSES + cell(after)] += 1
    want = {}
    for w in set(counts) - frequent:
        before, after = np.split(around[w], 2)
        gains = [
            before @ np.log(bigrams[:, k] + 0.5)
            + after @ np.log(bigrams[k] + 0.5)
            - counts[w] * (np.log(bigrams[:, k].sum() + brown.N_CLASSES / 2) + np.log(bigrams[k].sum() + brown.N_CLASSES / 2))
            for k in range(brown.CLASSES)
        ]
        want[number(w)] = (counts[w], gains)
    got, leads = collections.defaultdict(set), collections.Counter()
    for r in brown._placed(first, found, bigrams).collect():
        for at, c, k, lead in np.frombuffer(b"".join(r["entries"]), brown._ENTRY).tolist():
            got[r["words"][at] % 2**64].add((c, k))
            leads[r["words"][at] % 2**64] += lead
    assert set(leads.values()) == {1}
    for w, (n, gains) in want.items():
        ((c, k),) = got[w]
        assert c == n and gains[k] > max(gains) - 1e-9
    assert len({k for w in want for _, k in got[w]}) > 1
    assert all(v == {(0, brown.REST)} for w, v in got.items() if w not in want)


def test_brown_finds_words_that_are_frequent_only_in_sum(spark, monkeypatch):
    """A word with the share in one block, in none but in sum, or in few blocks only."""
    monkeypatch.setattr(brown, "FREQUENT", 50)
    rng = np.random.default_rng(6)
    rows, totals, n = [], collections.Counter(), 0
    for block in range(20):
        counts = {w: int(rng.integers(1, 40)) for w in rng.permutation(200)[:80].tolist()}
        rows.append((block, list(counts), list(counts.values()), sum(counts.values()) + 5))
        totals.update(counts)
        n += rows[-1][3]
    blocks = spark.createDataFrame(rows, "block bigint, words array<bigint>, n_train array<int>, n_learnt bigint")
    for share in (50, 150, 250, 400):
        monkeypatch.setattr(brown, "FREQUENT", share)
        hashes, counts = brown._frequent(blocks, n)
        want = {w: c for w, c in totals.items() if c * share >= n and c > 1}
        assert dict(zip(hashes.tolist(), counts.tolist())) == want
        assert hashes.tolist() == sorted(hashes.tolist())
    assert len(want) > 50
