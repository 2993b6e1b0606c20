"""N-gram Jaccard self-join by a token-group matrix.

A document's set holds the hashes of its distinct word shingles.  Equal sets
are one from the start.  Then:

1. Shingles are counted by document over hash buckets, hot ones beforehand, so
   that their entries can be spread.  A set of which less than the threshold is held by another set has no partner and is done with.
2. The rest is partitioned into groups of similar sets, by least hashes, and
   linked inside the groups; this is done a few times, each time with one
   leader for the sets linked so far.
3. The token-group matrix: each group's token union.  A set meets a group if
   they share one of its rarest tokens, as many as a partner could lack and
   one more (the prefix filter), is held against the group's union, and opens
   the group only if that bound on the overlap reaches the threshold.

Step 3 leaves out only what cannot reach the threshold, so no link between
components is lost; links inside a component are not looked for again, which
spares all pairs of a large group of near copies.  Numbers travel as packed
arrays, a row for many documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batched, hash128, staged
from tidemark.llm.graph import components

#: Tokens that a bucket holds on average, and sets or queries of a group opened at once.
BUCKET_TOKENS = 1 << 20
GROUP_ROWS = 256
#: Bytes of text that a task hashes at once.
TEXT_BYTES = 1 << 20
#: Tokens that a task deals to buckets at once.
PORTION_TOKENS = 1 << 20
#: A token is hot if more sets hold it than OFTEN for each PORTION_TOKENS of the
#: corpus, and HOT_SETS at least: PORTION_TOKENS / OFTEN tokens at most are.
OFTEN = 8
HOT_SETS = 1024

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], "u1")
_BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; other seeds give independent orders."""
    x = x + _U((0xA0761D6478BD642F * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A hash for each byte at each of the first places of a word.
_PLACES = 64
_BYTE_AT = mix(np.arange(256 * _PLACES, dtype=_U), 1)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end]: the sum of a hash of every byte
    together with its place, mixed with the length."""
    sizes = end - start
    if not len(sizes):
        return np.empty(0, _U)
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    at = place * 256 + data[place + np.repeat(start, sizes)]
    hashes = _BYTE_AT[np.minimum(at, len(_BYTE_AT) - 1)]
    far = np.flatnonzero(place >= _PLACES)
    hashes[far] = mix(at[far].astype(_U), 1)
    return mix(np.add.reduceat(hashes, first) + sizes.astype(_U))


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer than
    ``words`` of them are one shingle, none is an empty set.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = _FOLD[np.frombuffer(b" ".join(raw) + b" ", "u1")]
    sizes = np.array([len(r) + 1 for r in raw])
    begin_of = np.concatenate([[0], np.cumsum(sizes)])
    inside = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype("i1")))
    start, end = edge[::2], edge[1::2]
    word = _word_hashes(data, start, end)
    first = np.searchsorted(start, begin_of)
    n = len(word)
    if n >= words:
        rolled = word[:n - words + 1].copy()
        for k in range(1, words):
            rolled = rolled * _STEP + word[k:n - words + 1 + k]
        rolled = mix(rolled, words)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            h = np.zeros(1, _U)
            for w in word[a:b]:
                h = h * _STEP + w
            out.append(mix(h, b - a))
        else:
            out.append(np.empty(0, _U))
    return out


def set_hash(tokens: np.ndarray, seed: int = 0) -> int:
    """An order-free hash of a set, as a signed long."""
    total = (int(mix(tokens, 11 + seed).sum(dtype=_U)) + len(tokens) * int(_STEP)) % (1 << 64)
    return total - (1 << 64 if total >> 63 else 0)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows and their sets, some TEXT_BYTES of text (the first column) at a time."""
    for batch in batches:
        texts, held, begin = [], 0, 0
        for i, t in enumerate(batch.column(0), 1):
            text = t.as_py()
            texts.append(text)
            held += len(text or "")
            if held > TEXT_BYTES or i == batch.num_rows:
                yield batch.slice(begin, i - begin), shingle_sets(texts)
                texts, held, begin = [], 0, i


def _often(distinct: dict[int, np.ndarray]) -> bytes:
    """The tokens that more than OFTEN of the sets hold, then how many do."""
    tokens, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
    more = counts > OFTEN
    return tokens[more].astype("<u8").tobytes() + counts[more].astype("<u8").tobytes()


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, t1 and t2 (hashes of the text), n (set size) and set (its hash;
    null if empty) of each row; here and there ``often``, the tokens that are
    frequent among the PORTION_TOKENS before."""

    def run(batches):
        distinct: dict[int, np.ndarray] = {}
        held, last = 0, None
        for rows, sets in _portions(batches):
            if last is not None:
                yield last
            keys = [set_hash(s) if len(s) else None for s in sets]
            for key, s in zip(keys, sets):
                if key is not None and key not in distinct:
                    distinct[key] = s
                    held += len(s)
            often: list[bytes | None] = [None] * len(sets)
            if held > PORTION_TOKENS:
                often[-1], distinct, held = _often(distinct), {}, 0
            last = pa.RecordBatch.from_arrays(
                list(rows.columns[1:]) + [pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                                          pa.array(often, pa.binary())], ["doc_id", "t1", "t2", "n", "set", "often"])
        if last is not None:
            if distinct:
                rest = pa.array([None] * (last.num_rows - 1) + [_often(distinct)], pa.binary())
                last = last.set_column(5, "often", rest)
            yield last

    text = F.col("text").cast("string")
    t1, t2 = hash128(F.coalesce(text, F.lit("")))
    return batched(docs).select(text.alias("text"), F.col("doc_id").cast("long"), t1.alias("t1"), t2.alias("t2")).mapInArrow(
        run, "doc_id long, t1 long, t2 long, n long, set long, often binary")


def hot_tokens(ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hot tokens of ``document_sets``, sorted, and a count of each.

    The bound on their number holds as the counts of all tokens add up to no
    more than the tokens.  Sets count once a portion, and only where more than
    OFTEN hold the token, so a token that isn't among them is held by no more
    than twice the limit for each portion.
    """
    def rows_of(batches):
        for batch in batches:
            for blob in batch.column(0):
                both = np.frombuffer(blob.as_buffer(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in both], ["token", "held"])

    total = ids.agg(F.sum("n")).first()[0] or 0
    least = max(HOT_SETS, OFTEN * total // PORTION_TOKENS)
    hot = (ids.where("often is not null").select("often").mapInArrow(rows_of, "token long, held long")
           .groupBy("token").agg(F.sum("held").alias("held")).where(F.col("held") > least)).toArrow()
    tokens, held = hot.column("token").to_numpy().view(_U), hot.column("held").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], held[order]


def _bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens >> _U(16)) % _U(buckets)


def _places(tokens: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are in the sorted ``hot``, and where those are."""
    if not len(hot):
        return np.empty(0, "i8"), np.empty(0, "i8")
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    which = np.flatnonzero(hot[at] == tokens)
    return which, at[which]


def _bucketed(docs: DataFrame, buckets: int, hot) -> DataFrame:
    """Tokens by hash bucket: a row a bucket for each PORTION_TOKENS of a task.
    The entries of a hot token are spread over all buckets, by set."""

    def rows_of(distinct: dict[int, np.ndarray]) -> pa.RecordBatch:
        keys = np.array(list(distinct), "i8")
        tokens = np.concatenate(list(distinct.values()))
        owner = np.repeat(np.arange(len(keys), dtype="i4"), [len(s) for s in distinct.values()])
        bucket = _bucket_of(tokens, buckets)
        spread, _ = _places(tokens, hot.value[0])
        bucket[spread] = _bucket_of(mix(tokens[spread] ^ keys.view(_U)[owner[spread]], 3), buckets)
        order = np.argsort(bucket, kind="stable")  # keeps the documents in order
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        rows: list[list] = [[], [], [], []]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own, counts = np.unique(owner[a:b], return_counts=True)
            for col, v in zip(rows, (int(bucket[a]), keys[own].tobytes(), counts.astype("<u4").tobytes(),
                                     tokens[a:b].astype("<u8").tobytes())):
                col.append(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64())] + [pa.array(c, pa.binary()) for c in rows[1:]],
            ["bucket", "sets", "counts", "tokens"])

    def run(batches):
        distinct, held = {}, 0
        for _, sets in _portions(batches):
            for s in sets:
                if len(s) and (key := set_hash(s)) not in distinct:
                    distinct[key] = s
                    held += len(s)
            if held > PORTION_TOKENS:
                yield rows_of(distinct)
                distinct, held = {}, 0
        if distinct:
            yield rows_of(distinct)

    return batched(docs).select(F.col("text").cast("string")).mapInArrow(
        run, "bucket long, sets binary, counts binary, tokens binary")


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in column] or [np.empty(0, kind)])


def _shared(part: pa.Table, buckets: int, hot: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """A bucket's tokens that two sets or more hold, dealt by set.  How many hold
    a hot token, which only orders it, is known from before."""
    sets, counts = _joined(part.column("sets"), "<i8"), _joined(part.column("counts"), "<u4")
    tokens = _joined(part.column("tokens"), "<u8")
    keep = np.zeros(len(sets), bool)  # equal sets from several portions count once
    keep[np.unique(sets, return_index=True)[1]] = True
    tokens, owner = tokens[np.repeat(keep, counts)], np.repeat(sets[keep], counts[keep])
    order = np.argsort(tokens)
    tokens, owner = tokens[order], owner[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(tokens)) + 1, [len(tokens)]])
    held = np.repeat(np.diff(cuts), np.diff(cuts))
    which, place = _places(tokens, hot[0])
    held[which] = hot[1][place]
    more = held > 1
    tokens, owner, held = tokens[more], owner[more], np.minimum(held[more], 0xFFFFFFFF)
    shard = owner.view(_U) % _U(buckets)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else [0]
    rows: list[list] = [[], [], [], []]
    for a, b in zip(cuts[:-1], cuts[1:]):
        at = order[a:b]
        for col, v in zip(rows, (int(shard[a]), owner[at].tobytes(), tokens[at].tobytes(),
                                 held[at].astype("<u4").tobytes())):
            col.append(v)
    return pa.table([pa.array(rows[0], pa.int64())] + [pa.array(c, pa.binary()) for c in rows[1:]],
                    names=["shard", "sets", "tokens", "held"])


def _survivors(entries: pa.Table, sizes: pa.Table, percent: int) -> pa.Table:
    """Sets that may have a partner, with their shared tokens, rarest first."""
    out: list[list] = [[], [], [], []]
    if entries.num_rows and sizes.num_rows:
        n_of = dict(zip(sizes.column("set").to_pylist(), sizes.column("n").to_pylist()))
        sets, tokens = _joined(entries.column("sets"), "<i8"), _joined(entries.column("tokens"), "<u8")
        held = _joined(entries.column("held"), "<u4")
        keys, inverse, counts = np.unique(sets, return_inverse=True, return_counts=True)
        enough = np.array([100 * c >= percent * n_of[k] for k, c in zip(keys.tolist(), counts.tolist())])
        keep = enough[inverse]
        sets, tokens, held = sets[keep], tokens[keep], held[keep]
        order = np.lexsort((tokens, held, sets))
        sets, tokens, held = sets[order], tokens[order], held[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(sets)) + 1, [len(sets)]]) if len(sets) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = int(sets[a])
            for col, v in zip(out, (key, n_of[key], held[a:b].sum() / n_of[key], tokens[a:b].tobytes())):
                col.append(v)
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], names=["set", "n", "shared", "tokens"])


def _similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections in a group of a bounded number of sets."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    more = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[more]]
    owner = owner[more]
    out = np.zeros((len(sets), len(sets)), "f4")
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 8192
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        held = np.zeros((len(sets), width), "f4")
        held[owner[a:b], column[a:b] - lo] = 1
        out += held @ held.T
    return out.astype("i8")


def _linked(keys: list[int], n: np.ndarray, sets: list[np.ndarray], percent: int) -> list[int]:
    """A leader for each set of a group: of the sets it is linked with inside
    the group, the one with the most links."""
    if len(keys) == 1:
        return keys
    near = _similar(_overlaps(sets), n[:, None], n[None, :], percent)
    np.fill_diagonal(near, True)
    order = np.lexsort((np.array(keys, "i8"), -near.sum(axis=1)))
    label = np.empty(len(keys), "i8")
    label[order] = np.arange(len(keys))  # 0: most links
    while True:
        new = np.where(near, label[None, :], len(keys)).min(axis=1)
        if (new == label).all():
            return [keys[order[x]] for x in label.tolist()]
        label = new


def _grouped(rows: DataFrame, seed: int, percent: int, calls: int) -> DataFrame:
    """One grouping of ``rows(set, n, shared, tokens)`` by least token hash: set,
    leader, n, shared and, for leaders, the tokens.

    A group of up to GROUP_ROWS sets is linked as a whole.  In a larger one all
    sets are first held against its hub, the set whose tokens are the most
    shared, and what is left is linked in parts.
    """
    kinds = "set long, n long, shared double, tokens binary"

    def key(batches):
        for batch in batches:
            keys = [int(mix(np.frombuffer(t.as_buffer(), "<u8"), 100 + seed).min().astype("i8"))
                    for t in batch.column("tokens")]
            yield batch.append_column("key", pa.array(keys, pa.int64()))

    keyed = staged(rows.select("set", "n", "shared", "tokens").mapInArrow(key, kinds + ", key long"), "keyed")
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max(F.struct("shared", "set")).alias("h")) \
        .where(F.col("c") > GROUP_ROWS).select(
            "key", F.ceil(F.col("c") / GROUP_ROWS).cast("long").alias("parts"), F.col("h.set").alias("hub"))
    hubs = keyed.select(F.col("set").alias("hub"), F.col("n").alias("hub_n"), F.col("tokens").alias("hub_tokens"))
    large = staged(staged(large, "large").join(hubs, "hub"), "hubs")
    dealt = keyed.join(large, "key", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("set", F.lit(seed)), F.col("parts")), F.lit(0)))

    def to_hub(batches):
        last, sorted_hub = None, None
        for batch in batches:
            leaders = []
            for n, blob, hub, hub_n, hub_blob in zip(*(batch.column(c) for c in (
                    "n", "tokens", "hub", "hub_n", "hub_tokens"))):
                leader, hub = None, hub.as_py()
                if hub is not None:
                    if hub != last:
                        last, sorted_hub = hub, np.sort(np.frombuffer(hub_blob.as_buffer(), "<u8"))
                    n, m = n.as_py(), hub_n.as_py()
                    inter = _held(np.frombuffer(blob.as_buffer(), "<u8"), sorted_hub)
                    if 100 * inter >= percent * (n + m - inter):
                        leader = hub
                leaders.append(leader)
            yield batch.select(["set", "n", "shared", "tokens", "key", "part"]).append_column(
                "leader", pa.array(leaders, pa.int64()))

    met = staged(dealt.mapInArrow(to_hub, kinds + ", key long, part long, leader long"), "met")
    settled = met.where("leader is not null").select(
        "set", "leader", "n", "shared", F.when(F.col("set") == F.col("leader"), F.col("tokens")).alias("tokens"))

    def link(part: pa.Table) -> pa.Table:
        part = part.combine_chunks().sort_by([("key", "ascending"), ("part", "ascending")])
        keys, parts = part.column("key").to_numpy(), part.column("part").to_numpy()
        names, n = part.column("set").to_pylist(), part.column("n").to_numpy()
        blobs = part.column("tokens").to_pylist()
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(keys) != 0) | (np.diff(parts) != 0)) + 1, [len(keys)]])
        leaders: list[int] = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            leaders += _linked(names[a:b], n[a:b], [np.frombuffer(x, "<u8") for x in blobs[a:b]], percent)
        kept = [x if s == m else None for s, m, x in zip(names, leaders, blobs)]
        return pa.table([part.column("set"), pa.array(leaders, pa.int64()), part.column("n"), part.column("shared"),
                         pa.array(kept, pa.binary())], names=["set", "leader", "n", "shared", "tokens"])

    rest = met.where("leader is null").drop("leader").withColumn(
        "call", F.pmod(F.xxhash64("key", "part"), F.lit(calls)))
    linked = rest.groupBy("call").applyInArrow(
        link, "set long, leader long, n long, shared double, tokens binary")
    return settled.unionByName(linked)


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """The tokens of each set of which a partner holds one at least; ``short``
    marks those that do if the partner is no smaller.

    Rarest first, a partner that is no larger can lack so many tokens that it
    has one of the first n - ceil(t n) + 1, with t the threshold; a partner that
    is no smaller one of the first n - ceil(2 t n / (1 + t)) + 1.  The n less
    len(tokens) tokens that nobody shares come first.
    """

    def run(batches):
        for batch in batches:
            out: list[np.ndarray] = [np.empty(0, "<u8")]
            short: list[np.ndarray] = [np.empty(0, bool)]
            sizes = []
            for n, blob in zip(batch.column("n").to_pylist(), batch.column("tokens")):
                tokens = np.frombuffer(blob.as_buffer(), "<u8")
                alone = n - len(tokens)
                most = n + percent * -n // 100 + 1 - alone
                few = n + 2 * percent * -n // (100 + percent) + 1 - alone
                out.append(tokens[:max(0, most)])
                short.append(np.arange(len(out[-1])) < few)
                sizes.append(len(out[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view("i8"), pa.int64()), pa.array(np.concatenate(short))] +
                [pa.array(np.repeat(batch.column(c).to_numpy(), sizes), pa.int64())
                 for c in ("set", "n", "comp", "csize")], ["token", "short", "set", "n", "comp", "csize"])

    return sets.mapInArrow(run, "token long, short boolean, set long, n long, comp long, csize long")


def _opened(members: pa.Table, queries: pa.Table, percent: int) -> pa.Table:
    """Links from queries to a group, one a query, if its union lets it open."""
    edges: list[tuple[int, int]] = []
    if members.num_rows and queries.num_rows:
        sets = [np.sort(np.frombuffer(t, "<u8")) for t in members.column("tokens").to_pylist()]
        sizes = members.column("n").to_numpy()
        union = np.unique(np.concatenate(sets))
        group = members.column("comp")[0].as_py()
        for n, comp, blob in zip(queries.column("n").to_pylist(), queries.column("own").to_pylist(),
                                 queries.column("tokens")):
            q = np.frombuffer(blob.as_buffer(), "<u8")
            bound = _held(q, union)
            if 100 * bound < percent * n:
                continue
            for size, tokens in zip(sizes.tolist(), sets):
                if 100 * min(n, size) >= percent * max(n, size) and 100 * min(bound, size) >= percent * size:
                    inter = _held(q, tokens)
                    if 100 * inter >= percent * (n + size - inter):
                        edges.append((comp, group))
                        break
    edges = sorted(set(edges))
    return pa.table([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _held(q: np.ndarray, tokens: np.ndarray) -> int:
    """How many of ``q`` are in the sorted ``tokens``."""
    if not len(tokens):
        return 0
    at = np.minimum(np.searchsorted(tokens, q), len(tokens) - 1)
    return int((tokens[at] == q).sum())


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges between components: ``sets(set, n, tokens, comp, csize)``."""
    postings = staged(_postings(sets, percent), "postings")
    several = (postings.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                             F.max("short").alias("any")).where("lo < hi and any").select("token"))
    meeting = staged(postings.join(staged(several, "several"), "token"), "meeting")
    of_short = lambda f: f(F.when(F.col("short"), F.col("n")))
    by_group = staged(meeting.groupBy("token", F.col("comp").alias("group"), F.col("csize").alias("gsize")).agg(
        F.max("n").alias("n1"), of_short(F.min).alias("s0"), of_short(F.max).alias("s1")), "token-groups")
    # The set of the smaller component is held against the larger one, which
    # needs a set of a fitting size there: no larger one with the token among its
    # few, or no smaller one if the token is among the set's own few.
    n, least = F.col("n"), F.lit(percent) * F.col("n")
    pairs = (meeting.join(by_group, "token")
             .where("csize < gsize or (csize = gsize and comp < group)")
             .where(((F.col("s0") <= n) & (100 * F.col("s1") >= least)) | (F.col("short") & (F.col("n1") >= n)))
             .select("set", "group", "gsize", F.col("comp").alias("own")).distinct())
    pairs = staged(pairs, "pairs")
    asked = pairs.groupBy("group", "gsize").agg(F.count(F.lit(1)).alias("q")).select(
        "group", F.ceil(F.col("gsize") / GROUP_ROWS).cast("int").alias("chunks"),
        F.ceil(F.col("q") / GROUP_ROWS).cast("int").alias("salts"))
    asked = staged(asked, "asked")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    members = (sets.join(asked, F.col("comp") == F.col("group")).withColumn(
        "chunk", F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int"))
        .withColumn("salt", every("salts")).select("group", "chunk", "salt", "comp", "n", "tokens"))
    queries = (pairs.join(asked, "group").withColumn("salt", F.pmod(F.xxhash64("set"), F.col("salts")).cast("int"))
               .withColumn("chunk", every("chunks")).select("group", "chunk", "salt", "set", "own")
               .join(sets.select("set", "n", "tokens"), "set")
               .select("group", "chunk", "salt", "own", "n", "tokens"))
    by = ["group", "chunk", "salt"]
    members, queries = members.toDF(*members.columns), queries.toDF(*queries.columns)  # names of their own
    found = members.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(
        lambda m, q: _opened(m, q, percent), "a long, b long")
    return found


def near_duplicates(docs: DataFrame, percent: int = 80, groupings: int = 4) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, n_shingles, component_id;
    t1 and t2, hashes of the text, and class_id, the same for a component's rows.

    Two documents link when 100 * intersection >= ``percent`` * union of their
    sets of 5-word shingles; component_id is the smallest doc_id reachable.
    Documents without words link with nothing: they are their own component and
    have no class_id.  Repeated rows are documents of the same component.  Null
    ids are no smallest; a component without any other has a null component_id.
    """
    ids = staged(document_sets(docs), "sets")
    hot = docs.sparkSession.sparkContext.broadcast(hot_tokens(ids))  # PORTION_TOKENS / OFTEN tokens at most
    sets = staged(ids.where("set is not null").groupBy("set", "n").agg(F.min("doc_id").alias("least")), "distinct")
    found = _classes(docs, sets, percent, groupings, hot)
    named = staged(sets.join(found, "set", "left").select(
        "set", "least", F.coalesce("comp", "set").alias("class_id")), "named")
    roots = staged(named.groupBy("class_id").agg(F.min("least").alias("component_id")), "roots")
    classes = staged(named.join(roots, "class_id").select("set", "class_id", "component_id"), "classes")
    return ids.join(classes, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "t1", "t2", "class_id")


def keep_first(docs: DataFrame, percent: int = 80, groupings: int = 4) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row
    with the smallest doc_id (null ids last, then by the text's hash), and all
    documents without words.  Identical rows count as one, with or without words."""
    found = staged(near_duplicates(docs, percent, groupings), "near-duplicates")
    first = found.where("class_id is not null").groupBy("class_id").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")).alias("f"))
    kept = staged(first.select("f.doc_id", "f.t1", "f.t2").unionByName(
        found.where("class_id is null").select("doc_id", "t1", "t2")).distinct()
        .toDF("__id", "__k1", "__k2"), "kept")
    t1, t2 = hash128(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumns({"__t1": t1, "__t2": t2})
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["__id"]) & (rows["__t1"] == kept["__k1"])
                     & (rows["__t2"] == kept["__k2"]), "left_semi")
    repeated = found.groupBy("doc_id", "t1", "t2").count().where(F.col("count") > 1).limit(1).count()
    if repeated:
        rows = rows.dropDuplicates(["doc_id", "__t1", "__t2"])
    return rows.drop("__t1", "__t2")


def _classes(docs: DataFrame, sets: DataFrame, percent: int, groupings: int, hot) -> DataFrame:
    """set, comp for the sets that have a partner or may have one."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = int(max(64, -(-total // BUCKET_TOKENS)))
    shared = _bucketed(docs, buckets, hot).groupBy("bucket").applyInArrow(
        lambda part: _shared(part, buckets, hot.value), "shard long, sets binary, tokens binary, held binary")
    sized = sets.select("set", "n", _shard_of("set", buckets).alias("shard"))
    rows = staged(shared.groupBy("shard").cogroup(sized.groupBy("shard")).applyInArrow(
        lambda e, s: _survivors(e, s, percent), "set long, n long, shared double, tokens binary"), "survivors")

    calls = int(max(64, rows.count() // 1024))
    comp, leaders = rows.select("set", F.col("set").alias("comp")), rows
    for seed in range(groupings):
        step = staged(_grouped(leaders, seed, percent, calls), "grouping")
        to = step.select(F.col("set").alias("comp"), "leader")
        comp = staged(comp.join(to, "comp").select("set", F.col("leader").alias("comp")), "comp")
        leaders = step.where("set = leader")
    sizes = staged(comp.groupBy("comp").agg(F.count(F.lit(1)).alias("csize")), "comp-sizes")
    comp = staged(comp.join(sizes, "comp"), "comp")
    whole = staged(rows.join(comp, "set").select("set", "n", "tokens", "comp", "csize"), "whole")
    roots = staged(components(_links(whole, percent)), "roots")
    return staged(comp.join(roots, F.col("comp") == F.col("node"), "left").select(
        "set", F.coalesce("root", "comp").alias("comp")), "linked")


def _shard_of(column: str, shards: int):
    """An unsigned long modulo ``shards``, as numpy has it."""
    x = F.col(column)
    wrap = (1 << 64) % shards
    return F.pmod(F.pmod(x, F.lit(shards)) + F.when(x < 0, F.lit(wrap)).otherwise(F.lit(0)),
                  F.lit(shards)).cast("long")
