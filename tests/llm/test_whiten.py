import math

import numpy as np
import pytest

from tidemark.llm import whiten

VECTORS = "vec_id long, embedding array<float>, whitened string, component string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "w", "c", "n") for i, v in rows], VECTORS)


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute(rows, k):
    """Whitened, deviations and shares by numpy's own eigenvectors."""
    kept = usable(rows)
    dim = max(len(v) for _, v in kept)
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in [*v, *[0.0] * (dim - len(v))]] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    d = [[n * c - s for c, s in zip(v, sums)] for v in x]
    a = np.array(d, float) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [i for i, _ in kept], n, [sum(c * c for c in v) for v in d], a @ vectors[:, :k], values, values[:k] / values.sum()


def check(spark, rows, k=8):
    ids, n, deviation, projected, values, share = brute(rows, k)
    got = whiten.whiten(table(spark, rows), k).collect()
    k = min(k, len(values))
    assert len(got) == len(ids) * k
    want = {}
    for row, i in enumerate(ids):
        want.setdefault((i, deviation[row]), []).append(row)
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert sorted((r.vec_id, r.deviation) for r in mine) == sorted(zip(ids, deviation))
        assert {r.n for r in mine} == {n}
        assert all(abs(r.explained - share[c]) <= 1e-9 * share[c] for r in mine)
        w = np.array([r.whitened for r in mine])
        p = projected[[want[(r.vec_id, r.deviation)][0] for r in mine], c] / math.sqrt(values[c])
        assert min(np.abs(w - p).max(), np.abs(w + p).max()) < 1e-6
    assert {r.identity_error < 1e-9 for r in got} == {True}
    assert len({r.identity_error for r in got}) == 1


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 12)) * np.linspace(0.4, 0.05, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (4, rows[4][1])]
    check(spark, rows + odd)
    check(spark, rows[:40], k=20)
    check(spark, [(i, v[:3]) for i, v in rows])


def test_badly_conditioned_rows(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(200, 10)) * 300 * 10.0 ** -np.arange(0, 5, 0.5)
    model = whiten.fit(table(spark, [(i, v.tolist()) for i, v in enumerate(m)]), 10)
    _, _, _, _, values, _ = brute([(i, v.tolist()) for i, v in enumerate(m)], 10)
    assert np.allclose(model.eigen, values, rtol=1e-6)


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(50, 2)).tolist()
    rows = [(i, [a, b, 0.25, a, b, 0.0]) for i, (a, b) in enumerate(base)]
    got = whiten.whiten(table(spark, rows)).collect()
    assert {(r.component, r.whitened is None, r.explained == 0) for r in got} == {
        (c, c > 2, c > 2) for c in range(1, 7)}
    assert got[0].identity_error < 1e-9
    # fewer rows than dimensions
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(4, 6)))]
    got = whiten.whiten(table(spark, rows)).collect()
    assert {(r.component, r.whitened is None) for r in got} == {(c, c > 3) for c in range(1, 7)}


@pytest.mark.parametrize("rows", [[(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 3 + [(None, [0.5, 0.5])]])
def test_equal_rows_have_no_direction(spark, rows):
    got = whiten.whiten(table(spark, rows)).collect()
    assert sorted(((r.vec_id or 0, r.component, r.whitened, r.deviation, r.explained, r.identity_error) for r in got)) \
        == sorted((i or 0, c, None, 0, 0.0, 0.0) for i, _ in rows for c in (1, 2))


def test_short_empty_and_huge_vectors(spark):
    check(spark, [(1, [0.5, 0.25, 1.0]), (2, []), (3, [0.75]), (4, [0.1, 0.9, -0.3]), (5, [-0.5, 0.5, 0.2])], k=3)
    rows = [(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)]
    got = whiten.whiten(table(spark, rows)).collect()
    assert len(got) == 12 and {r.n for r in got} == {6} and {r.deviation for r in got} == {None}
    exact = whiten.apply(table(spark, rows).select("vec_id", "embedding"), whiten.fit(table(spark, rows))).collect()
    half = 6 * (1 << 52)
    step = [6 * 1024 * i - 1024 * 15 for i in range(6)]
    assert sorted(int(r.deviation) for r in exact) == sorted(half * half + s * s for s in step)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        assert whiten.whiten(table(spark, rows)).collect() == []
