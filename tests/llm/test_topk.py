import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk

VECTORS = "vec_id long, embedding array<float>, rank string, score string"


def brute(rows, k, every):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def check(spark, rows, k=5, every=7, **how):
    table = spark.createDataFrame([(i, v, "r", "s") for i, v in rows], VECTORS)
    got = topk.top_k(table, F.col("vec_id") % every == 0, k, **how).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, k, every)


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = random.Random(18)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 520)] + [(7, [0.5] * 8), (14, rows[14][1])]
    rows += [(1001, None), (1002, [None] * 8), (1003, [float("nan")] + [0.0] * 7), (1008, [float("inf")] * 8),
             (None, [1.0] * 8), (1015, [1.0, 2.0]), (1022, [])]
    check(spark, rows, shard_rows=64, block=40)
    check(spark, rows)


def test_many_slices_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLICE_SHARDS", 2)
    rng = random.Random(20)
    check(spark, [(i, [rng.gauss(0, 0.2) for _ in range(4)]) for i in range(600)], every=3, shard_rows=40, block=50)


def test_fewer_candidates_than_k_and_empty(spark):
    check(spark, [(0, [1.0, 2.0]), (7, [2.0, 1.0]), (1, [0.0, -1.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])
    check(spark, [(1, [1.0, 2.0])])


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(19)
    points = np.floor(rng.normal(size=(2000, 3)) * 50)
    tree = topk.KdTree(np.arange(2000), points, leaf=16)
    opened = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            opened.append(len(self))
            return np.asarray(self) @ other

    tree.points = tree.points.view(Counted)
    for q in points[:20]:
        best = []
        tree.search(q, -1, 5, best)
        scores = points @ q
        want = sorted(zip(-scores, range(2000)))[:5]
        assert sorted((-s, -i) for s, i in best) == want
    assert sum(opened) < 20 * 2000 / 4
