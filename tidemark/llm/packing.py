"""Best-fit-decreasing packing of tokenised documents into sequences.

Pieces are spread by hash over groups of a bounded size; inside a group
they are placed longest first, each into the open sequence with the least room
that still fits it.  A segment tree over the remaining capacities finds that
sequence in logarithmic time.  A group leaves a handful of part-filled
sequences behind, so with thousands of pieces a group the total stays within a
fraction of a percent of one global run, and no task ever holds more than a group.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batched, staged

END = "<|endoftext|>"
#: Runs of white space from here on are left to the slower library, whose
#: splitter has no backtracking limit.
LONG_SPACE = 4096


class ByteBpe:
    """Token ids of the byte-level vocabulary in ``folder``.

    The ids are those of ``tokenizers`` with ``byte_bpe_50k.json``; the same
    vocabulary as ranks gives them about four times as fast, and the few texts
    that its splitter can't take go through ``tokenizers`` itself.
    """

    def __init__(self, folder: str | None):
        import re

        import public_tokenizers as P
        import tiktoken

        where = (lambda n: f"{folder}/{n}") if folder else P.path
        self.json = where("byte_bpe_50k.json")
        with open(where("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=P.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={END: len(ranks)})
        self.slow = None
        self.long = re.compile(r"\s{%d}" % LONG_SPACE)

    def ids(self, text: str) -> np.ndarray:
        if self.long.search(text):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.json)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode(text, allowed_special="all"), "<u4")


_LOADED: dict = {}


def _bpe(folder: str | None) -> ByteBpe:
    if folder not in _LOADED:
        _LOADED[folder] = ByteBpe(folder)
    return _LOADED[folder]


def pieces(docs: DataFrame, size: int = 2048, tokenizers: str | None = None,
           with_ids: bool = True) -> DataFrame:
    """Cut tokenised documents: doc_id, piece, start, length, ids_crc32[, ids].

    A document is its text's ids and a closing id 0 (a null text: only that).
    Longer ones are cut into ``size``-token pieces, of which the first may be
    shorter.  ``tokenizers`` is the folder of the vocabulary files.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizers)
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(bpe.ids(text.as_py() or ""), np.uint32(0)).astype("<u4")
                first = (len(ids) - 1) % size + 1
                edges = [0, *range(first, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b]
                    row = (doc.as_py(), k, a, b - a, zlib.crc32(part.tobytes()),
                           part if with_ids else None)
                    for col, v in zip(cols, row):
                        col.append(v)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds)]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array([x.astype("i8") for x in cols[5]], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


class RoomTree:
    """Segment tree over remaining capacities 0..size: each leaf counts the
    open sequences with that much room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """The least room >= need with an open sequence, or -1."""
        i, count = need + self.leaves, self.count
        if count[i]:
            return need
        while i > 1:  # climb until a right neighbour has one, then go down leftmost
            if not i & 1 and count[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return -1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) for lengths given longest first, each 1..size."""
    tree, open_at = RoomTree(size), [[] for _ in range(size + 1)]
    seqs, offsets, made = [], [], 0
    for n in lengths:
        room = tree.tightest(n)
        if room < 0:
            seq, room, made = made, size, made + 1
        else:
            seq = open_at[room].pop()
            tree.add(room, -1)
        seqs.append(seq)
        offsets.append(size - room)
        if room > n:
            open_at[room - n].append(seq)
            tree.add(room - n, 1)
    return seqs, offsets


def pack(docs: DataFrame, size: int = 2048, tokenizers: str | None = None,
         group_pieces: int = 4096, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row a piece: doc_id, piece, start,
    length, ids_crc32[, ids], sequence_id, offset.

    Sequences hold at most ``size`` tokens and are gapless from offset 0.
    Full pieces take a sequence each.  The others are packed best-fit
    decreasing in hash groups of about ``group_pieces``, ties by doc_id and
    piece.  Every row is a document: repeated rows and null ids are packed like
    any other.  An empty table gives no row; other columns are left out.
    """
    rows = staged(pieces(docs, size, tokenizers, with_ids), "pieces")
    groups = max(1, -(-rows.where(F.col("length") < size).count() // group_pieces))
    # The crc spreads rows with equal ids; equal rows are interchangeable.
    keyed = rows.withColumn("__g", F.when(F.col("length") < size, F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))))
    names = rows.columns
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", sequence_id long, offset long"

    def place(part: pa.Table) -> pa.Table:
        group = part.column("__g")[0].as_py()
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"),
                             ("piece", "ascending"), ("ids_crc32", "ascending")])
        seqs, offsets = best_fit(part.column("length").to_pylist(), size)
        ids = np.array(seqs, "i8") * groups + group
        return part.select(names).append_column("sequence_id", pa.array(ids * 2, pa.int64())) \
            .append_column("offset", pa.array(offsets, pa.int64()))

    short = keyed.where(F.col("__g").isNotNull()).groupBy("__g").applyInArrow(place, schema)
    full = rows.where(F.col("length") >= size).select(
        *names, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return short.unionByName(full)
