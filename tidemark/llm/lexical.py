"""Ranked lexical search over norm buckets.

A document's impact vector has an entry for each term that some query asks for;
the entries of a query's terms, times the terms' weights, add up to its score.
Documents are ordered by the length of that vector and read in buckets of
neighbouring lengths.  By Cauchy and Schwarz no document of a bucket beats the
query's length times the bucket's largest length, which rules out whole buckets
against the kth score so far.  Inside a bucket the entries of the query's heaviest
terms are added up, and what is left of both vectors bounds the rest; documents
whose bound stays below the kth score go.  Only the survivors are scored, exactly,
in integers.

Queries come in blocks whose terms have a bounded size; the longest documents
are searched first, and their kth scores are the thresholds that all tasks start with.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.llm.common import batched, staged

#: Bytes of query text in a block (a longer query is a block of its own, at most doubled).
BLOCK_BYTES = 8 << 20
#: Entries of impact vectors in a bucket.
BUCKET_ENTRIES = 1 << 20
#: Documents searched first.
SEEDS = 4096
#: Share of a query's squared length that its heaviest terms have to make up.
FOCUS = 0.75
#: Bounds are made larger by this, for rounding errors of doubles.
SLACK = 1 + 1e-9

#: Bytes of terms: ASCII letters (A-Z as a-z), digits, and all bytes beyond ASCII.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM).split(b" ")


def _counts(text: bytes) -> Counter:
    out = Counter(terms_of(text))
    del out[b""]
    return out


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.to_pylist()]


def _lists(sizes: list[int], flat: list[int] | np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.array(sizes, "i8"))]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.asarray(flat, "i4")))


class Queries:
    """A block of queries: their terms numbered, and each query's terms."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.terms = [np.array(sorted({self.number.setdefault(t, len(self.number)) for t in _counts(text)}), "i8")
                      for text in texts]


def _vectors(docs: DataFrame, shared) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs (of the block's terms), for
    documents with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            keep, ns, sizes, terms, tfs = [], [], [], [], []
            for i, text in enumerate(_bytes(batch.column(1))):
                counts = _counts(text)
                if not counts:
                    continue
                known = sorted((number[t], c) for t, c in counts.items() if t in number)
                keep.append(i)
                ns.append(counts.total())
                sizes.append(len(known))
                terms += [t for t, _ in known]
                tfs += [c for _, c in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int32())), pa.array(ns, pa.int64()),
                 _lists(sizes, terms), _lists(sizes, tfs)], ["doc_id", "n", "terms", "tfs"])

    rows = batched(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term, summed by task and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, "i8")
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    out = np.zeros(size, "i8")
    sums = vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.toLocalIterator():  # a row a term of the block
        out[r["term"]] = r["df"]
    return out


def _impacts(vectors: DataFrame, weights: np.ndarray, docs: int, occurrences: int) -> DataFrame:
    """doc_id, norm, terms and impacts; documents without any impact are left
    out, as they score nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            wide = n.max(initial=0) * 90 * docs >= 1 << 62
            share = (90 * n.astype(object if wide else "i8") * docs) // occurrences
            m = (10 + share).astype("i8")
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            terms = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy().astype("i8")
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
            row = np.repeat(np.arange(len(sizes)), sizes)
            norm = np.sqrt(np.bincount(row, weights[terms] * impact.astype("f8") ** 2, minlength=len(sizes)))
            keep = norm > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), pa.array(norm[keep]),
                 _lists(sizes[keep], terms[keep[row]]), _lists(sizes[keep], impact[keep[row]])],
                ["doc_id", "norm", "terms", "impacts"])

    return vectors.mapInArrow(run, "doc_id long, norm double, terms array<int>, impacts array<int>")


class Bucket:
    """Documents of neighbouring lengths, with their entries by term as well."""

    def __init__(self, batches: list[pa.RecordBatch], size: int):
        table = pa.Table.from_batches(batches)
        ids = pa.chunked_array(table.column("doc_id")).combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.norms = table.column("norm").to_numpy()
        self.longest = float(self.norms.max())
        sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in batches])
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        self.terms = np.concatenate([b.column(2).flatten().to_numpy() for b in batches]).astype("i8")
        self.impacts = np.concatenate([b.column(3).flatten().to_numpy() for b in batches]).astype("i8")
        order = np.argsort(self.terms, kind="stable")
        self.by_doc = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.by_impact = self.impacts[order].astype("f8")
        self.edges = np.searchsorted(self.terms[order], np.arange(size + 1))

    def survivors(self, terms: np.ndarray, weights: np.ndarray, least: int) -> np.ndarray:
        """Documents that may score ``least``.  ``terms`` are the query's, the
        heaviest first; entries count as impact times the root of the weight."""
        squares = np.cumsum(weights[terms])
        focus = int(np.searchsorted(squares, FOCUS * squares[-1])) + 1
        rest = math.sqrt(max(0.0, float(squares[-1] - squares[focus - 1])))
        lists = [slice(self.edges[t], self.edges[t + 1]) for t in terms[:focus]]
        of = np.concatenate([np.full(x.stop - x.start, w) for x, w in zip(lists, weights[terms[:focus]])])
        docs = np.concatenate([self.by_doc[x] for x in lists])
        impact = np.concatenate([self.by_impact[x] for x in lists])
        known = np.bincount(docs, of * impact, minlength=len(self.norms))
        if not rest:
            return np.flatnonzero(known * SLACK >= least)
        seen = np.bincount(docs, of * impact ** 2, minlength=len(self.norms))
        left = np.sqrt(np.maximum(0, self.norms ** 2 * SLACK - seen))
        return np.flatnonzero((known + rest * left) * SLACK >= least)

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores; ``weight_of`` has the query's weights and 0 elsewhere."""
        begins, ends = self.begins[docs], self.begins[docs + 1]
        size = ends - begins
        at = np.arange(size.sum()) + np.repeat(begins - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return np.add.reduceat(weight_of[self.terms[at]] * self.impacts[at], np.concatenate([[0], np.cumsum(size)[:-1]]))


def _search(impacts: DataFrame, queries: Queries, weights: np.ndarray, least: list[int], k: int,
            bucket_entries: int) -> DataFrame:
    """query, doc_id, score of each task's ``k`` best documents a query, of
    those that score at least ``least``."""
    size = len(queries.number)
    known = [t[np.argsort(-weights[t], kind="stable")] for t in queries.terms]
    known = [t[weights[t] > 0] for t in known]
    lengths = np.array([math.sqrt(float(weights[t].sum())) for t in known])
    shared = impacts.sparkSession.sparkContext.broadcast((known, weights, lengths, np.array(least, "i8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, lengths, least = shared.value
        least = least.copy()
        best: list[tuple] = [(np.empty(0, "i8"), np.empty(0, bool), np.empty(0, "i8"))] * len(terms)
        weight_of = np.zeros(size, "i8")

        def search(bucket: Bucket) -> None:
            for q in np.flatnonzero(lengths * bucket.longest * SLACK >= least).tolist():
                if not len(terms[q]):
                    continue
                docs = bucket.survivors(terms[q], weights, int(least[q]))
                if not len(docs):
                    continue
                weight_of[terms[q]] = weights[terms[q]]
                scores = bucket.scores(docs, weight_of)
                weight_of[terms[q]] = 0
                keep = scores >= least[q]
                if not keep.any():
                    continue
                merged = [np.concatenate(x) for x in zip(
                    best[q], (scores[keep], bucket.null[docs[keep]], bucket.ids[docs[keep]]))]
                first = np.lexsort((merged[2], merged[1], -merged[0]))[:k]
                best[q] = tuple(x[first] for x in merged)
                if len(first) == k:
                    least[q] = max(least[q], best[q][0][-1])

        held, entries = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                entries += len(batch.column(2).flatten())
            if entries >= bucket_entries:
                search(Bucket(held, size))
                held, entries = [], 0
        if held:
            search(Bucket(held, size))
        for q, (scores, null, ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), q)), pa.array(ids, mask=null), pa.array(scores)],
                    ["query", "doc_id", "score"])

    return impacts.mapInArrow(run, "query long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _answer(docs: DataFrame, ids: pa.Array, texts: list[bytes], schema: StructType, k: int,
            bucket_entries: int, seeds: int) -> DataFrame:
    """Answers one block of queries."""
    spark = docs.sparkSession
    queries = Queries(texts)
    number = spark.sparkContext.broadcast(queries.number)
    vectors = staged(_vectors(docs, number), "lexical-terms")
    n_docs, occurrences = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not queries.number:
        return spark.createDataFrame([], schema)
    df = _frequencies(vectors, len(queries.number))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], "i8")
    impacts = staged(_impacts(vectors, weights, n_docs, occurrences), "lexical-impacts")

    def search(rows: DataFrame, least: list[int]) -> DataFrame:
        return _search(rows, queries, weights, least, k, bucket_entries)

    longest = impacts.orderBy(F.desc("norm")).limit(seeds)
    kth = _best(search(longest, [1] * len(texts)), k).where(F.col("rank") == k).collect()  # a row a query
    least = [1] * len(texts)
    for r in kth:
        least[r["query"]] = r["score"]
    # Equal lengths are dealt out by a hash, so that a group of copies is no partition of its own.
    lined = impacts.withColumn("deal", F.xxhash64("doc_id", F.monotonically_increasing_id())) \
        .repartitionByRange(F.desc("norm"), "deal").sortWithinPartitions(F.desc("norm")).drop("deal")
    found = staged(_best(search(lined, least), k).select("query", "rank", "doc_id", "score"), "lexical-found")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [ids.take(batch.column(0)), *batch.columns[1:]], ["item_id", "rank", "doc_id", "score"])

    return found.mapInArrow(name, schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES,
           bucket_entries: int = BUCKET_ENTRIES, seeds: int = SEEDS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs(doc_id, text, ...)``
    for each row of ``items(item_id, text, ...)``.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and characters
    beyond ASCII.  N documents have a term, L terms altogether; a term in df of
    them weighs floor(1000 ln((2N+2)/(2df+1))).  In a document of n terms, with
    m = 10 + 90nN div L, a term that stands there tf times adds its weight times
    1000000000tf div (1000tf + 8m); a query's terms count once each.

    Only scores above 0 are returned; ties go to the smaller doc_id, a null id is
    the last.  Null and empty texts have no terms: such documents are never found,
    such items have no rows.  Repeated rows are documents, and items, of their own.
    Empty tables give no row; other columns are left out.  The terms of a block of
    items are broadcast; each block is one more pass over the documents.
    """
    schema = items.select("item_id").schema.add("rank", "integer").add("doc_id", "long").add("score", "long")
    asked = batched(items).select("item_id", F.col("text").cast("string").cast("binary").alias("text")) \
        .where(F.octet_length("text") > 0)
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes))
    asked = staged(asked.withColumn("block", F.pmod(
        F.xxhash64("text", F.monotonically_increasing_id()), F.lit(blocks))), "lexical-items")
    out = docs.sparkSession.createDataFrame([], schema)
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).select("item_id", "text").toArrow()  # about block_bytes / 2
        if rows.num_rows:
            ids = pa.array(rows.column("item_id").to_pylist(), to_arrow_type(schema["item_id"].dataType))
            out = out.unionByName(_answer(docs, ids, _bytes(rows.column("text")), schema, k, bucket_entries, seeds))
    return out
