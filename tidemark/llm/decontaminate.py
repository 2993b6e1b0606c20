"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of all normalised test items; a
document's words are streamed through it while the length of the longest match
ending at each word is tracked.  Where that length reaches a window, the
window's words are hit.

The automaton of a block of items is broadcast; a block is closed at
``BLOCK_BYTES`` of item text.  Of several blocks each is a pass over the
documents of its own: its hits are written and its broadcast is freed before
the next block starts, so what is held at once, also by the driver, which
builds the automata one by one, never grows with the benchmark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batched, hash128, staged

#: About 200,000 words: some 150 MB of automaton in a Python worker.
BLOCK_BYTES = 1 << 20
#: UTF-8 bytes to lower-cased word bytes; all that is no word byte to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over item word sequences.

    ``step[state]`` maps a word id to a state, ``link`` is the suffix link and
    ``length`` the longest string of a state.  ``ends[state]`` lists, for
    strings that are windows, the items in which they occur.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(key, [self.words.setdefault(w, len(self.words)) for w in ws])
                 for key, ws in items if ws]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._add(last, w)
        # Items of fewer words are windows of their own length.
        self.found: dict[tuple[int, int], set[str]] = {}
        for key, ws in coded:
            size = min(window, len(ws))
            state = matched = 0
            for w in ws:
                state, matched = self.advance(state, matched, w)
                if matched >= size:
                    at = self.at_length(state, size)
                    self.found.setdefault((at, size), set()).add(key)
        self.sizes = sorted({size for _, size in self.found})
        # The windows that are suffixes of what a state has matched.
        self.hits: dict[int, list[tuple[int, frozenset[str]]]] = {}
        by_state: dict[int, list[tuple[int, frozenset[str]]]] = {}
        for (at, size), keys in self.found.items():
            by_state.setdefault(at, []).append((size, frozenset(keys)))
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            own = by_state.get(state, []) + (self.hits.get(self.link[state], []) if state else [])
            if own:
                self.hits[state] = sorted(own, key=lambda x: -x[0])

    def _add(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:  # another item began alike
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, q, w)
        new = len(link)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        clone = len(self.link)
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def advance(self, state: int, matched: int, w: int) -> tuple[int, int]:
        """State and match length after one more word."""
        step = self.step
        while state and w not in step[state]:
            state = self.link[state]
            matched = self.length[state]
        to = step[state].get(w)
        return (0, 0) if to is None else (to, matched + 1)

    def at_length(self, state: int, size: int) -> int:
        """The state of the suffix of ``size`` words of a state's match."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (start, end exclusive; disjoint, in order) and items."""
        spans: list[tuple[int, int]] = []
        keys: set[str] = set()
        step, link, length, hits = self.step, self.link, self.length, self.hits
        least = self.sizes[0] if self.sizes else 1 << 60
        state = matched = 0
        for i, w in enumerate(map(self.words.get, words)):
            if w is None:
                state = matched = 0
                continue
            to = step[state].get(w)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = step[state].get(w)
                matched = length[state]
            if to is None:
                state = matched = 0
                continue
            state = to
            matched += 1
            if matched >= least and state in hits:
                begin = i + 1
                for size, own in hits[state]:
                    if size <= matched:
                        begin = min(begin, i + 1 - size)
                        keys |= own
                if begin <= i:
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, i + 1))
        return spans, keys


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items' keys and texts in blocks of a bounded size."""
    rows = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("k"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes))
    return [rows] if blocks == 1 else [
        rows.where(F.pmod(F.xxhash64("k", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def _automaton(block: DataFrame, window: int) -> SuffixAutomaton:
    return SuffixAutomaton([(r.k, words_of(r.text)) for r in block.collect()], window)


SPANS = "array<struct<start:int,end:int>>"


def _hits(docs: DataFrame, block: DataFrame, window: int) -> DataFrame:
    """__k1, __k2 (hashes of the text), spans and items of the texts that a
    block hits, each text once; written."""
    k1, k2 = hash128(F.coalesce("text", F.lit("")))
    shared = docs.sparkSession.sparkContext.broadcast(_automaton(block, window))
    schema = f"__k1 long, __k2 long, spans {SPANS}, items array<string>"
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
             pa.list_(pa.string())]

    def run(batches):
        automaton = shared.value
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for text, a, b in zip(*batch.columns):
                spans, keys = automaton.scan(words_of(text.as_py()))
                if spans:
                    for col, v in zip(rows, (a.as_py(), b.as_py(), [{"start": x, "end": y} for x, y in spans], sorted(keys))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                             ["__k1", "__k2", "spans", "items"])

    out = staged(batched(docs).where(F.col("text").isNotNull()).select("text", k1, k2).mapInArrow(
        run, schema).distinct(), "hits")
    shared.destroy()
    return out


def scan(docs: DataFrame, items: DataFrame, window: int = 10,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with added columns ``__n_words``, ``__spans`` (hit word ranges)
    and ``__items`` (keys of items with occurring windows, sorted as text).

    A window is ``window`` consecutive item words; an item of fewer, but not
    none, is one window.  Null texts have no words; items with a null id or
    text take no part; an id given to several texts is one item.
    """
    spark = docs.sparkSession
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("__n_words", "__spans", "__items")]
    blocks = _blocks(items, block_bytes)
    shared = None
    if len(blocks) == 1:
        shared = spark.sparkContext.broadcast(_automaton(blocks[0], window))
        rows = batched(docs).select(*columns)
        spans, keys = F.array().cast(SPANS), F.array().cast("array<string>")
    else:
        every = None
        for block in blocks:
            one = _hits(docs, block, window)
            every = one if every is None else every.unionByName(one)
        hits = staged(every.groupBy("__k1", "__k2").agg(
            F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("items")).alias("__items")), "hits")
        k1, k2 = hash128(F.coalesce("text", F.lit("")))
        rows = batched(docs).select(*columns, k1.alias("__k1"), k2.alias("__k2")).join(hits, ["__k1", "__k2"], "left")
        spans, keys = [F.coalesce(c, F.array().cast(t)) for c, t in (("__spans", SPANS), ("__items", "array<string>"))]
    out = rows.select(*columns, F.lit(0).cast("long").alias("__n_words"), spans.alias("__spans"), keys.alias("__items"))

    def run(batches):
        automaton = shared.value if shared else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            n, spans, found = [], [], []
            for text, s0, k0 in zip(texts, batch.column(batch.num_columns - 2).to_pylist(),
                                    batch.column(batch.num_columns - 1).to_pylist()):
                ws = words_of(text.as_py())
                s, k = automaton.scan(ws) if automaton else (_merged([(x["start"], x["end"]) for x in s0]), set(k0))
                n.append(len(ws))
                spans.append([{"start": a, "end": b} for a, b in s])
                found.append(sorted(k))
            fields = list(batch.schema)[-3:]
            new = [pa.array(v, f.type) for v, f in zip((n, spans, found), fields)]
            yield pa.RecordBatch.from_arrays(
                list(batch.columns)[:-3] + new, schema=pa.schema(list(batch.schema)[:-3] + fields))

    return out.mapInArrow(run, out.schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and ``spans``, the hit word ranges."""
    found = scan(docs.select("doc_id", "text"), items, window, block_bytes)
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), hit.alias("n_hit"),
        F.array_size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.array_size("__spans") > 0).alias("contaminated"), F.col("__spans").alias("spans"))


def remove_spans(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its contaminated spans, same columns.

    Each run of hit words (at least a window long, or a whole short item) is
    cut out with the marks between its words.  A document of which more than
    ``max_coverage`` of the words are hit goes as a whole.  Documents without
    a hit are returned as they are; ``n_chars`` is kept in step with the text.
    """
    columns = docs.columns
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema
    found = scan(docs, items, window, block_bytes)
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    found = found.where((F.array_size("__spans") == 0) | (hit <= max_coverage * F.col("__n_words")))

    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            spans = batch.column(batch.schema.get_field_index("__spans")).to_pylist()
            if any(spans):
                texts = [without(t, [(x["start"], x["end"]) for x in s]) if s else t
                         for t, s in zip(batch.column(at).to_pylist(), spans)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch

    cleaned = found.mapInArrow(cut, found.schema)
    if "n_chars" in columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.array_size("__spans") > 0, F.char_length("text"))
                                     .otherwise(F.col("n_chars")).cast(schema["n_chars"].dataType))
    return cleaned.select(*[F.col(f"`{c}`") for c in columns])


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given word ranges."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = raw.translate(_FOLD)
    places, at = [], 0
    for w in folded.split():
        at = folded.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:places[a][0]])
        last = places[b - 1][1]
    out.append(raw[last:])
    return b"".join(out).decode("utf-8", "surrogatepass")
