"""The operators on vectors against brute force, on a small table with awkward rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corridor.llm import bisectors, secular, va_file, whitening
from corridor.llm.batches import ready
from corridor.llm.secular import Spectrum

DIMS = 6
CLASHING = "cluster int, score bigint, rank int, v array<double>, h bigint, query int, block int, n int, part int"
SCHEMA = f"vec_id bigint, embedding array<float>, {CLASHING}"
NAN, INF = float("nan"), float("inf")


def some_vectors() -> list[tuple[int | None, list | None]]:
    rng = np.random.default_rng(5)
    near = (rng.integers(-6, 7, size=(150, DIMS)) / 64).tolist()
    rows: list[tuple[int | None, list | None]] = list(enumerate(near))
    rows += [(1000 + i, [0.25] * DIMS) for i in range(80)]
    rows += [
        (300, None),
        (301, [None] * DIMS),
        (302, [0.5] * (DIMS - 1) + [NAN]),
        (303, [INF] + [0.1] * (DIMS - 1)),
        (304, [-INF] * DIMS),
        (305, [0.1] * (DIMS - 1) + [None]),
        (5, near[5]),
        (5, near[5]),
        (10, near[11]),
        (None, near[7]),
        (None, [0.5] * DIMS),
        (2**62, [-0.0] * DIMS),
        (-50, [1.5, -2.25, 0.0, 0.125, 3.0, -1.0]),
        (400, [0.3, -0.7]),
        (401, []),
    ]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, v, 1, 2, 3, [0.5], 4, 5, 6, 7, 8) for i, v in some_vectors()]
    return ready(spark).createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def finite(v: list | None) -> bool:
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def as_floats(v: list) -> list[float]:
    return [float(np.float32(c)) for c in v]


def by_text(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)


def lloyd(rows, k, rounds, scale):
    """Plain rounds of comparing every vector with every centroid."""
    kept = [
        (i, [math.floor(scale * c) for c in as_floats(v)])
        for i, v in rows
        if finite(v) and len(v) == DIMS
    ]
    first = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]),
    )
    centroids = [x for _, x in first[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [
            [sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c
            for n, c in enumerate(centroids)
        ]
    found = [(i, *nearest(x)) for i, x in kept]
    inertia = {n: sum(d for _, d, m in found if m == n) for n in range(k)}
    return [
        (
            i,
            n,
            d,
            inertia[n],
            sum(inertia.values()),
            hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest(),
        )
        for i, d, n in found
    ]


@pytest.mark.parametrize("k", [1, 2, 7])
def test_clusters_equal_plain_rounds(table, k):
    got = bisectors.cluster_vectors(table, k=k, dims=DIMS)
    assert by_text(got.collect()) == by_text(lloyd(some_vectors(), k, 3, 64))


def test_more_centroids_than_vectors(spark):
    rows = [(i, [i / 64.0] * DIMS) for i in range(3)]
    got = bisectors.cluster_vectors(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), dims=DIMS)
    assert sorted(r["distance"] for r in got.collect()) == [0, 0, 0]
    assert len({r["cluster"] for r in got.collect()}) == 3


def test_huge_components_count_as_the_limit(spark):
    rows = [(i, [s * 3e38] * 64) for i, s in enumerate([1, -1, 1, -1, 0])] * 2
    got = bisectors.cluster_vectors(
        spark.createDataFrame(rows, "vec_id int, embedding array<float>"), k=1, rounds=0
    ).collect()
    top = bisectors.limit(64)
    assert {r["distance"] for r in got} <= {0, 64 * top * top, 64 * 4 * top * top}
    assert all(0 <= r["distance"] for r in got)
    assert got[0]["inertia"] is None


def test_ties_go_to_the_smaller_centroid():
    pairs = bisectors.Bisectors.of(np.array([[2, 0], [0, 2], [2, 0], [1, 1]]))
    x = np.array([[0, 0], [2, 0], [3, 3], [1, 1], [0, 9]])
    assert pairs.nearest(x).tolist() == [3, 0, 3, 3, 1]
    assert bisectors.Bisectors.of(np.array([[2, 0], [0, 2], [2, 0]])).nearest(x).tolist() == [0, 0, 0, 0, 1]


def brute_top_k(rows, every, k):
    """Every query against every row."""
    kept = [(i, [math.floor(256 * c) for c in as_floats(v)]) for i, v in rows if finite(v)]
    asked = {(i, tuple(x)) for i, x in kept if i is not None and i % every == 0}
    out = []
    for q, x in asked:
        scores = [(-sum(a * b for a, b in zip(x, y)), i is None, i) for i, y in kept if i != q]
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(q, rank, i, -s) for rank, (s, _, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("cells, block", [(2, 2048), (16, 3), (256, 1)])
def test_top_k_equals_comparing_all(table, cells, block):
    queries = table.where(F.col("vec_id") % 5 == 0)
    got = va_file.search(table, queries, cells=cells, sample_rows=40, query_block=block)
    assert by_text(got.collect()) == by_text(brute_top_k(some_vectors(), 5, 5))


def test_all_rows_if_there_are_fewer_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    got = va_file.search(df, df.where("vec_id = 0"), k=9).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 128 * 256 + 128 * 512), (2, -256 * 256)]


def test_huge_products_stay_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**28), 2**28, size=(60, 64))
    df = spark.createDataFrame(
        [(i, (v / 256).tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<double>"
    )
    got = va_file.search(df, df.where("vec_id % 10 = 0"), cells=8).collect()
    want = []
    for q in range(0, 60, 10):
        best = sorted(((-int(sum(int(a) * int(b) for a, b in zip(x[q], x[i]))), i) for i in range(60) if i != q))
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best[:5], 1)]
    assert by_text(got) == by_text(want)


def test_few_exact_vectors_are_read(spark, monkeypatch):
    """With narrow cells a task reads little more than it returns."""
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 100, size=(2000, 8))
    cells = va_file.Cells(np.tile(np.arange(-96, 100, 4), (8, 1)))
    numbers = cells.numbers(x)
    n = cells.borders.shape[1] + 1
    low, high = np.zeros((8, n), int), np.zeros((8, n), int)
    for d in range(8):
        for c in range(n):
            inside = x[numbers[:, d] == c, d]
            if len(inside):
                low[d, c], high[d, c] = inside.min(), inside.max()
    full = va_file.Cells(cells.borders, low, high)
    query = va_file.Queries(np.array([-1]), x[:1])
    lo, hi = full.edges(numbers)
    upper = (hi @ query.up + lo @ query.down)[:, 0]
    lower = (lo @ query.up + hi @ query.down)[:, 0]
    exact = x @ x[0]
    assert (lower <= exact).all() and (exact <= upper).all()
    best, read = va_file.Best(5), []
    monkeypatch.setattr(best, "add", lambda s, i: (read.append(len(i)), va_file.Best.add(best, s, i)))
    blobs = va_file.pa.array([v.tobytes() for v in x], va_file.pa.binary())
    va_file.read_exact(best, x[0], np.arange(2000), upper, np.arange(2000), blobs)
    assert sorted(best.scores.tolist(), reverse=True) == sorted(exact.tolist(), reverse=True)[:5]
    assert sum(read) < 500


def matrix_of(rows) -> tuple[list, np.ndarray]:
    kept = [(i, as_floats(v) + [0.0] * (DIMS - len(v))) for i, v in rows if finite(v)]
    return [i for i, _ in kept], np.floor(1024 * np.array([v for _, v in kept])).astype(np.int64) + 100_000


def test_whitening_equals_a_plain_decomposition(table):
    got = whitening.whiten(table, components=4).toPandas()
    ids, x = matrix_of(some_vectors())
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors[:, :4] / np.sqrt(values[:4])
    assert set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    for component in range(1, 5):
        part = got[got["component"] == component]
        np.testing.assert_allclose(part["explained"], values[component - 1] / values.sum(), rtol=1e-12)
        # Rows are told apart by id and deviation; the sign of a component is free.
        have = sorted(zip(part["vec_id"].fillna(-9).astype(int), part["deviation"], part["whitened"]))
        fits = [
            np.allclose(
                [h[2] for h in have],
                [w[2] for w in sorted(zip([-9 if i is None else i for i in ids], deviation, s * want[:, component - 1]))],
                atol=1e-8,
            )
            for s in (1, -1)
        ]
        assert any(fits)
        assert sorted(part["deviation"]) == sorted(deviation)


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], "vec_id int, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(i, [i / 8, 0.25]) for i in range(9)], "vec_id int, embedding array<float>")
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)


def test_deviations_beyond_a_long_are_null():
    centre = whitening.Centre(10**9, [10**9 * 100_000 + 7], 1024, 100_000)
    got = centre.deviations(np.array([[0.0], [1.0], [3.0], [4.0]])).to_pylist()
    want = [(10**9 * (1024 * c + 100_000) - 10**14 - 7) ** 2 for c in (0, 1, 3, 4)]
    assert got == [w if w < 2**63 else None for w in want]
    assert got[0] is not None and got[-1] is None


def test_many_spectra_are_combined_level_by_level(spark):
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(300, 5)) * 30)
    parts = []
    for at in range(40):
        s = Spectrum.empty(5)
        for v in x[at::40]:
            s.add(v)
        parts.append((at, s.n, None, s.mean.tolist(), s.values.tolist(), bytearray(s.basis.tobytes())))
    got = whitening.combined(spark.createDataFrame(parts, whitening.SPECTRUM), 5, fan_in=3)
    centred = x - x.mean(axis=0)
    assert got.n == 300
    np.testing.assert_allclose((got.basis * got.values) @ got.basis.T, centred.T @ centred, atol=1e-8)


def cases():
    rng = np.random.default_rng(0)
    yield rng.normal(size=(400, 12)) * 32
    yield np.repeat(rng.normal(size=(3, 9)), 30, axis=0)
    yield np.eye(16)[rng.integers(0, 16, 100)]
    yield np.zeros((5, 3))
    yield rng.integers(0, 3, size=(50, 1)).astype(float)
    yield rng.normal(size=(100, 8)) * 10.0 ** np.arange(8)
    yield rng.normal(size=(60, 6)) * 1e120
    yield rng.normal(size=(60, 6)) * 1e-120


@pytest.mark.parametrize("x", list(cases()))
def test_rank_one_updates_equal_a_plain_decomposition(x):
    spectrum = Spectrum.empty(x.shape[1])
    for row in x:
        spectrum.add(row)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    scale = max(np.abs(scatter).max(), np.finfo(float).tiny)
    np.testing.assert_allclose(spectrum.basis.T @ spectrum.basis, np.eye(x.shape[1]), atol=1e-12)
    np.testing.assert_allclose((spectrum.basis * spectrum.values) @ spectrum.basis.T / scale, scatter / scale, atol=1e-12)
    assert (np.diff(spectrum.values) >= 0).all()


def test_copies_count_as_often_as_they_come():
    x = np.random.default_rng(3).normal(size=(20, 4))
    one, many = Spectrum.empty(4), Spectrum.empty(4)
    for row in x:
        one.add(row, 5)
    for row in np.repeat(x, 5, axis=0):
        many.add(row)
    assert one.n == many.n == 100
    np.testing.assert_allclose(one.values, many.values, atol=1e-10)


def test_near_poles_are_deflated():
    values = np.array([1.0, 1.0 + 1e-16, 2.0, 3.0])
    basis, z = np.eye(4), np.array([0.5, 0.5, 0.0, 0.25])
    kept = secular.deflate(values, basis, z, 1e-14)
    assert len(kept) == 2 and np.allclose(basis.T @ basis, np.eye(4))


def test_empty_tables(empty, table):
    assert bisectors.cluster_vectors(empty, dims=DIMS).count() == 0
    assert va_file.search(empty, empty).count() == 0
    assert va_file.search(table, empty).count() == 0
    assert va_file.search(empty, table).count() == 0
    assert whitening.whiten(empty).count() == 0
