"""Exact top-k by inner product with a KD-tree per shard.

Vectors are spread over shards of a bounded size by hash.  Each shard's tree is
built once by median splits along the widest dimension, every node with its
tight bounding box, and is written as one row.  Queries come in blocks of a
bounded size, a row each, which meet the shards by slices of a few shards; each
query descends a shard's tree best box first and stops when the best box left
can't beat its kth score so far.  A block passes that kth score on from shard to
shard of a slice.  Neither vectors nor trees go through the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import batched, staged

SHARD_ROWS = 4096
LEAF_ROWS = 128
#: Queries of a block, at most about.
BLOCK = 8192
#: Shards of a slice at most.
SLICE_SHARDS = 16


class KdTree:
    """Median splits over integer vectors held as doubles (exact below 2^53)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, left, right (-1: leaf)
        lows, highs = [], []

        def build(begin: int, end: int) -> int:
            at = len(self.nodes)
            part = points[order[begin:end]]
            low, high = part.min(axis=0), part.max(axis=0)
            self.nodes.append((begin, end, -1, -1))
            lows.append(low)
            highs.append(high)
            spread = high - low
            if end - begin > leaf and spread.size and spread.max() > 0:
                middle = (end - begin) // 2
                split = np.argpartition(part[:, int(spread.argmax())], middle)
                order[begin:end] = order[begin:end][split]
                left = build(begin, begin + middle)
                self.nodes[at] = (begin, end, left, build(begin + middle, end))
            return at

        if len(ids):
            build(0, len(ids))
        self.low, self.high = np.array(lows), np.array(highs)
        self.ids, self.points = ids[order], points[order]

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[float, int]]) -> None:
        """Improve ``best``, a heap of (score, -id), of at most ``k``."""
        if not self.nodes:
            return
        # The highest inner product that a point of each box can have.
        bounds = self.high @ np.maximum(query, 0) + self.low @ np.minimum(query, 0)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, at = heapq.heappop(queue)
            if len(best) == k and -bound < best[0][0]:
                return
            begin, end, left, right = self.nodes[at]
            if left >= 0:
                heapq.heappush(queue, (-bounds[left], left))
                heapq.heappush(queue, (-bounds[right], right))
                continue
            scores, ids = self.points[begin:end] @ query, self.ids[begin:end]
            if len(best) == k:
                keep = (scores >= best[0][0]) & (ids != own)
            else:
                keep = ids != own
            scores, ids = scores[keep], ids[keep]
            if len(ids) > k:
                first = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[first], ids[first]
            for s, i in zip(scores.tolist(), ids.tolist()):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))


def _finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                               & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (floor(256 x) of every component, as doubles) of the
    rows that take part: id and vector not null, all components finite."""
    x = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & _finite(F.col("x"))))


def _matrix(column: pa.ListArray | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of floor(256 x), short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype("f8"))
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = 0
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at:at + n]
        at += n
    return out


def build_index(rows: DataFrame, dim: int, shards: int) -> DataFrame:
    """One row a shard: its tree's points, ids, nodes and boxes."""
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)))

    def build(part: pa.Table) -> pa.Table:
        tree = KdTree(part.column("vec_id").to_numpy(), _matrix(part.column("x"), dim))
        blobs = [np.asarray(a).astype(t).tobytes() for a, t in (
            (tree.ids, "<i8"), (tree.points, "<f8"), (tree.nodes, "<i4"), (tree.low, "<f8"), (tree.high, "<f8"))]
        return pa.table([pa.array([part.column("shard")[0].as_py()], pa.int64())]
                        + [pa.array([b], pa.binary()) for b in blobs],
                        names=["shard", "ids", "points", "nodes", "low", "high"])

    return keyed.groupBy("shard").applyInArrow(
        build, "shard long, ids binary, points binary, nodes binary, low binary, high binary")


def query_blocks(queries: DataFrame, dim: int, blocks: int) -> DataFrame:
    """One row a block of ``queries(vec_id, x)``: its ids and points."""
    keyed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)))

    def pack(part: pa.Table) -> pa.Table:
        ids = part.column("vec_id").to_numpy().astype("<i8")
        return pa.table([pa.array([part.column("block")[0].as_py()], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                         pa.array([_matrix(part.column("x"), dim).astype("<f8").tobytes()], pa.binary())],
                        names=["block", "asked", "asked_points"])

    return keyed.groupBy("block").applyInArrow(pack, "block long, asked binary, asked_points binary")


def _tree(batch: pa.RecordBatch, i: int, dim: int) -> KdTree:
    tree = KdTree.__new__(KdTree)
    ids, points, nodes, low, high = (batch.column(c)[i].as_buffer() for c in ("ids", "points", "nodes", "low", "high"))
    tree.ids = np.frombuffer(ids, "<i8")
    tree.points = np.frombuffer(points, "<f8").reshape(-1, dim)
    tree.nodes = [tuple(x) for x in np.frombuffer(nodes, "<i4").reshape(-1, 4).tolist()]
    tree.low = np.frombuffer(low, "<f8").reshape(-1, dim)
    tree.high = np.frombuffer(high, "<f8").reshape(-1, dim)
    return tree


def _answers(key: tuple[int, int], own: np.ndarray, best: list[list[tuple[float, int]]]) -> pa.RecordBatch:
    """The heaps of a block, its ids ``own`` in order, as rows."""
    out = [(key[1], no, q, -i, int(score)) for no, (q, heap) in enumerate(zip(own.tolist(), best)) for score, i in heap]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
                                      ["block", "no", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS,
          block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` best candidates.

    ``vectors(vec_id, embedding, ...)``; queries are the rows for which
    ``is_query`` holds, candidates all rows with another id.  Components x
    count as floor(256 x); the score is their inner product.  Ties go to the
    smaller id.  Rows without an id, vectors null or with a null or non-finite
    component take no part; shorter vectors count as filled up with zeros.  A
    repeated row is a candidate each time and, as a query, answered each time.
    A task holds a shard's tree and a block of queries at a time.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    empty = "query_id long, rank int, vec_id long, score long"
    if not dim:
        return spark.createDataFrame([], empty)
    queries = rows.where(is_query)
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-2 * queries.count() // block))
    # Few shards are spread over all cores, many go by SLICE_SHARDS.
    slices = max(-(-shards // SLICE_SHARDS), min(shards, spark.sparkContext.defaultParallelism))
    index = staged(build_index(rows, dim, shards), "kd-index").withColumn(
        "slice", F.pmod("shard", F.lit(slices))).repartition(slices, "slice")
    asked = staged(query_blocks(queries, dim, blocks), "kd-queries").withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))).repartition(slices, "slice")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The sort-merge join gives a block's shards one after the other.
        last, own, points, best = None, np.empty(0, "<i8"), np.empty((0, dim)), []
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("slice")[i].as_py(), batch.column("block")[i].as_py())
                if key != last:
                    if last is not None:
                        yield _answers(last, own, best)
                    last, own = key, np.frombuffer(batch.column("asked")[i].as_buffer(), "<i8")
                    points = np.frombuffer(batch.column("asked_points")[i].as_buffer(), "<f8").reshape(-1, dim)
                    best = [[] for _ in own]
                tree = _tree(batch, i, dim)
                for q, query_id, heap in zip(points, own.tolist(), best):
                    tree.search(q, query_id, k, heap)
        if last is not None:
            yield _answers(last, own, best)

    met = batched(asked.hint("merge").join(index, "slice"))
    found = met.mapInArrow(search, "block long, no long, query_id long, vec_id long, score long")
    w = Window.partitionBy("block", "no").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
