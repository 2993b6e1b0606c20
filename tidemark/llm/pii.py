"""Personal data: patterns, and bootstrapped contextual extraction.

The patterns give the base spans, which seed the bootstrap.  Every word with a
digit and every run of digit groups is a candidate instance, and the words
around it are its lexical patterns.  Spark scores the graph of patterns and
instances in rounds: a pattern by the share of known instances among those it
meets, an instance by the patterns it meets.  Before a pattern is trusted, the
texts are searched for all that stands in its slot, with or without a digit.
Instances that confident patterns discover are added wherever they stand.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import spans as S
from tidemark.llm.common import batched, hash128, staged

#: The kinds and their patterns, in order.
KINDS = ("email", "ip", "card", "phone", "context")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"\s")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
#: Digit groups joined by blanks, brackets or hyphens; short words in capitals may stand between.
_GROUP, _JOINT = r"(?=[A-Z]*[0-9])[A-Z0-9]++", r"[\x20\xa0()-]{1,3}"
RUN = re.compile(r"""(?<![^\s\[{("'<*#%&|:=,;])(?:\((?=\+?[A-Z0-9]+\)))?\+?"""
                 rf"{_GROUP}(?:{_JOINT}(?:[A-Z]{{1,4}}{_JOINT})?{_GROUP})+"
                 r"""(?=[\s.,;:!?)\]}"'>*#%&|]|$)""")
#: Marks between letters that set an identifier apart from a word of prose.
_MARKED = re.compile(r"[^\W_][@_./\\:+=~$#&()\[\]{}]+[^\W_]")
_TRIM = ".,;:!?()[]{}<>\"'*#%&|"
#: Code points on each side in which the words of a pattern are looked for.
REACH = 48
#: Distinct words whose hashes a task keeps, and their code points.
KEPT_WORDS, KEPT_CHARS = 1 << 18, 1 << 25
#: Bits at most of the broadcast filter of patterns or instances looked for.
FILTER_BITS = 1 << 26


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and dotted domain.

    The local part is the whole run of its characters before the @, from the
    last match on, as the leftmost match would take it.
    """
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[S.Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped."""
    found = [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return S.ordered(found, KINDS)


def _hash(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return (zlib.crc32(raw) << 31) ^ zlib.crc32(raw[::-1], 1)


def _mixed(kind: int, a, b):
    """64 bits of a pattern from its words' hashes, integers or unsigned arrays."""
    full = (1 << 64) - 1
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + kind * 0x165667B19E3779F9) & full
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & full
    return x ^ (x >> 32)


def pattern_hash(pattern: str) -> int:
    words = pattern.split(" ")
    kind = words.index("_")
    x = _mixed(kind, *[_hash(w) for w in words if w != "_"])
    return x - (1 << 64 if x >> 63 else 0)


def patterns_of(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: two words before; one on each side.
    A word that the reach cuts counts as a whole."""
    begin = max(0, start - REACH)
    while 0 < begin < start and _WORD.match(text[begin]) and _WORD.match(text[begin - 1]):
        begin -= 1
    before = [w.lower() for w in _WORD.findall(text, begin, start)][-2:]
    after = _WORD.search(text, end, min(len(text), end + REACH))
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {_WORD.match(text, after.start())[0].lower()}")
    return out


def digit_runs(text: str, base: list[S.Span], least: int = 5) -> list[tuple[int, int]]:
    """Runs of digit groups, of ``least`` characters, between the base spans."""
    out, at = [], 0
    if not _DIGIT.search(text):
        return out
    for a, b in sorted((a, b) for _, a, b in base) + [(len(text), len(text))]:
        out += [m.span() for m in RUN.finditer(text, at, a) if m.end() - m.start() >= least] if at < a else []
        at = max(at, b)
    return out


def _meets(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether one of some spans, in order and apart, shares a place with a to b."""
    i = bisect_left(spans, (b, b))
    return i > 0 and spans[i - 1][1] > a


def candidates(text: str, base: list[S.Span], least: int = 5) -> list[tuple[int, int, bool]]:
    """Base spans, and other words with a digit, of ``least`` characters."""
    out = [(a, b, True) for _, a, b in base]
    at = 0
    while (m := _DIGIT.search(text, at)) is not None:
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, m.end())
        end = at = space.start() if space else len(text)
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        if end - start >= least and not any(a < end and start < b for _, a, b in base):
            out.append((start, end, False))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """uid, doc_id, t1, t2 (hashes of the text), base, and found: the candidates
    with hashes of the instance and its patterns, of which there may be none.
    A word that shares a place with a run of digit groups isn't ``main``.
    ``uid`` tells rows apart once this is written."""
    found = "array<struct<start:int,end:int,seed:boolean,main:boolean,instance:long,patterns:array<long>>>"

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            base, every, uid = [], [], []
            for value in batch.column(3):
                text = value.as_py() or ""
                own = base_spans(text)
                joined, words = digit_runs(text, own), candidates(text, own)
                known = {(a, b) for a, b, _ in words}
                alone = [s for s in joined if s not in known]
                rows = []
                for a, b, seed, main in [(*w, w[2] or not _meets(alone, *w[:2])) for w in words] + [
                        (*s, False, True) for s in alone]:
                    rows.append({"start": a, "end": b, "seed": seed, "main": main, "instance": _hash(text[a:b].lower()),
                                 "patterns": [pattern_hash(p) for p in patterns_of(text, a, b)]})
                base.append(own)
                every.append(rows)
                uid.append(number)
                number += 1
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("main", pa.bool_()),
                                       ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid, pa.int64()), *batch.columns[:3], S.column(base), pa.array(every, kind)],
                ["uid", "doc_id", "t1", "t2", "base", "found"])

    return _hashed(docs).mapInArrow(
        run, f"uid long, doc_id long, t1 long, t2 long, base {S.SPANS}, found {found}")


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    t1, t2 = hash128(F.coalesce(text, F.lit("")))
    return batched(docs).select(F.col("doc_id").cast("long"), t1.alias("t1"), t2.alias("t2"), text.alias("text"))


class _Tokens(dict):
    """Tokens' rows in ``table``: hashes of the bare token, its first, last and
    last but one word; number of words, and whether it has a letter or digit."""

    def __init__(self):
        self.table, self.held = np.zeros((1024, 6), "u8"), 0

    def __missing__(self, token: str) -> int:
        n, bare = len(self), token.strip(_TRIM)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        own = _hash(bare.lower())
        words = [own] if bare.isalpha() else [_hash(w.lower()) for w in _WORD.findall(bare)]
        first, last, second = (words[0], words[-1], words[-2] if len(words) > 1 else 0) if words else (0, 0, 0)
        self.table[n] = own, first, last, second, len(words), bool(words) or _DIGIT.search(bare) is not None
        self[token] = n
        self.held += len(token)
        return n


def _filter(values: DataFrame) -> np.ndarray:
    """A bit for each of the first column's values, in a map of bounded size."""
    size = min(FILTER_BITS, max(1 << 10, 1 << (64 * values.count()).bit_length()))
    at = values.select(F.pmod(F.col(values.columns[0]), F.lit(size)).cast("long").alias("at")).distinct() \
        .toArrow().column("at").to_numpy()
    bits = np.zeros(size // 8, "u1")
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype("u1"))
    return bits


def _set(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype("i8")] >> (at & np.uint64(7)).astype("u1")) & 1 == 1


def _slots_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's tokens (rows of _Tokens.table): both patterns around each, and where there are such."""
    _, first, last, second, count, _ = tokens.T
    has = count > 0
    w = np.flatnonzero(has)
    none = np.zeros(len(tokens), "u8")
    if not len(w):
        return none, none, none > 0, none > 0
    before = np.cumsum(has) - has  # words' tokens before each token
    own = w[np.maximum(before - 1, 0)]
    two = np.where(count[own] > 1, second[own], last[w[np.maximum(before - 2, 0)]])
    after = before + has
    return (_mixed(2, two, last[own]), _mixed(1, last[own], first[w[np.minimum(after, len(w) - 1)]]),
            (before > 1) | ((before > 0) & (count[own] > 1)), (before > 0) & (after < len(w)))


def slots(docs: DataFrame, patterns: DataFrame | None = None, instances: DataFrame | None = None,
          part: int = 1) -> DataFrame:
    """Words that are no candidates of ``scan`` and stand in a slot of
    ``patterns(pattern)`` or are of ``instances(instance)``, and a few others
    (the filters take hashes): t1, t2, start, end, instance, odd and patterns.
    ``odd`` words are identifiers by their marks.  One text of ``part`` is searched."""
    shared = docs.sparkSession.sparkContext.broadcast(
        [None if x is None else _filter(x) for x in (patterns, instances)])
    schema = "t1 long, t2 long, start int, end int, instance long, odd boolean, patterns array<long>"

    def run(batches):
        slot, named = shared.value
        memo = _Tokens()
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            if len(memo) > KEPT_WORDS or memo.held > KEPT_CHARS:
                memo = _Tokens()
            for t1, t2, value in zip(*batch.columns[1:]):
                text = value.as_py() or ""
                words = text.split()
                if not words:
                    continue
                at = np.fromiter(map(memo.__getitem__, words), "i8", len(words))
                tokens = memo.table[at]
                hit = np.zeros(len(words), bool)
                if slot is not None:
                    a, b, has_a, has_b = _slots_of(tokens)
                    hit |= (has_a & _set(slot, a)) | (has_b & _set(slot, b))
                if named is not None:
                    hit |= _set(named, tokens[:, 0])
                hit = np.flatnonzero(hit & (tokens[:, 5] > 0)).tolist()
                if not hit:
                    continue
                places = [m.span() for m in _TOKEN.finditer(text)]
                own = base_spans(text)
                taken = [sorted((a, b) for _, a, b in own), digit_runs(text, own),
                         [(a, b) for a, b, seed in candidates(text, own) if not seed]]
                for i in hit:
                    bare = words[i].strip(_TRIM)
                    start = places[i][0] + len(words[i]) - len(words[i].lstrip(_TRIM))
                    end = start + len(bare)
                    if any(_meets(t, start, end) for t in taken[1:]) or any(a < end and start < b for a, b in taken[0]):
                        continue
                    for col, v in zip(rows, (t1.as_py(), t2.as_py(), start, end, _hash(bare.lower()),
                                             len(bare) >= 5 and _MARKED.search(bare) is not None,
                                             [pattern_hash(p) for p in patterns_of(text, start, end)])):
                        col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                             [c.split()[0] for c in schema.split(", ")])

    rows = _hashed(docs)
    return (rows if part == 1 else rows.where(F.pmod("t2", F.lit(part)) == 0)).mapInArrow(run, schema)


def bootstrap(edges: DataFrame, rounds: int = 3, least_support: float = 5.0,
              least_pattern: float = 0.8, least_instance: float = 0.8, least_share: float = 0.5,
              look: Callable[[DataFrame | None, DataFrame | None, int], DataFrame] | None = None) -> DataFrame:
    """Instances that confident patterns discover: ``edges(instance, pattern,
    seed, main)`` -> instance, score.

    A pattern's confidence is the sum of its main instances' scores by their
    number plus one; below ``least_pattern``, or with a sum under
    ``least_support``, it counts for nothing.  A seed scores 1, another instance
    the chance that not all its patterns are wrong; below ``least_instance``
    that is 0.  Distinct pairs count once, however often they stand in the corpus.

    ``look(patterns, instances, part)``, as ``slots`` has it, gives further
    words: all in the slots of a pattern before it is trusted, and all places of
    those discovered.  Of such words, those that aren't odd need ``least_share`` of
    the patterns that they meet (about, by a sketch) to be confident ones.
    """
    if "main" not in edges.columns:
        edges = edges.withColumn("main", F.lit(True))
    graph = staged(edges.groupBy("instance", "pattern").agg(
        F.max("seed").alias("seed"), F.max("main").alias("main"), F.lit(True).alias("odd")), "graph")
    first = graph.select("instance").distinct()
    seeds = staged(graph.where("seed").select("instance", F.lit(1.0).alias("score")).distinct(), "scores")

    def sure_of(graph: DataFrame, score: DataFrame) -> DataFrame:
        sums = (graph.where("main").join(score, "instance", "left").groupBy("pattern")
                .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("held"), F.count(F.lit(1)).alias("n")))
        return staged(sums.withColumn("trust", F.col("held") / (F.col("n") + 1))
                      .where((F.col("held") >= least_support) & (F.col("trust") >= least_pattern))
                      .select("pattern", "held", "n", "trust"), "patterns")

    def with_words(graph: DataFrame, words: DataFrame) -> DataFrame:
        more = words.select("instance", "pattern", F.lit(False).alias("seed"), F.lit(True).alias("main"), "odd")
        return staged(graph.unionByName(more).groupBy("instance", "pattern").agg(
            *[F.max(c).alias(c) for c in ("seed", "main", "odd")]), "graph")

    score, asked, met, placed = seeds, None, None, None
    for r in range(rounds):
        sure = sure_of(graph, score)
        # More words only lower a pattern's trust: those that fail on few texts need no look at all.
        for part in (64, 8, 1) if look else ():
            new = sure.select("pattern") if asked is None else sure.select("pattern").join(asked, "pattern", "left_anti")
            if (new := staged(new, "asked")).isEmpty():
                break
            words = look(new, None, part).select("instance", "odd", F.explode("patterns").alias("pattern"))
            words = staged(words.join(new, "pattern").distinct(), "slots")
            if part > 1:
                n = words.groupBy("pattern").agg(F.count(F.lit(1)).alias("words"))
                sure = staged(sure.join(n, "pattern", "left").where(F.col("held") >= least_pattern * (
                    F.greatest("n", F.coalesce("words", F.lit(0))) + 1)).select("pattern", "held", "n", "trust"), "patterns")
            else:
                graph = with_words(graph, words)
                asked = new if asked is None else asked.unionByName(new)
                sure = sure_of(graph, score)
        told = staged(graph.join(sure, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"), F.count(F.lit(1)).alias("k"),
            F.max("odd").alias("odd")).where(F.col("score") >= least_instance), "told")
        plain = told.where("not odd").select("instance")
        new = plain if met is None else plain.join(met, "instance", "left_anti")
        if look and not (new := staged(new, "plain")).isEmpty():
            counted = staged(look(None, new, 1).join(new, "instance").select("instance", F.explode("patterns").alias("pattern"))
                             .groupBy("instance").agg(F.approx_count_distinct("pattern", 0.02).alias("met")), "met")
            met = counted if met is None else met.unionByName(counted)
        if met is not None:
            told = staged(told.join(met, "instance", "left").where(
                F.col("odd") | (F.col("k") >= least_share * F.col("met"))), "told")
        score = staged(seeds.unionByName(told.select("instance", "score")).groupBy("instance").agg(
            F.max("score").alias("score")), "scores")
        if look and r + 1 < rounds:
            new = told.select("instance").join(first, "instance", "left_anti")
            new = new if placed is None else new.join(placed, "instance", "left_anti")
            if not (new := staged(new, "placed")).isEmpty():
                graph = with_words(graph, look(None, new, 1).join(new, "instance").select(
                    "instance", "odd", F.explode("patterns").alias("pattern")).distinct())
                placed = new if placed is None else placed.unionByName(new)
    return score.join(seeds, "instance", "left_anti")


def find(docs: DataFrame, rounds: int = 3, **limits: float) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, base and spans (base ones
    and those discovered), both as arrays of (kind, start, end) in order.

    Whole texts are searched; null and empty ones have no span.  Every row is a
    document: repeated rows and null ids come out as they came in, and an
    instance in copies of a text counts once for each pattern.
    """
    rows = staged(scan(docs), "candidates")
    places = rows.select("uid", F.inline("found"))
    edges = places.select("instance", "seed", "main", F.explode("patterns").alias("pattern"))
    known = staged(bootstrap(edges, rounds, look=lambda *by: slots(docs, *by), **limits), "discovered")
    more = places.where(~F.col("seed")).join(known, "instance").select("uid", "start", "end")
    if not known.isEmpty():
        marks = staged(slots(docs, None, known.select("instance")).join(known, "instance")
                       .select("t1", "t2", "start", "end").distinct(), "marks")
        more = more.unionByName(rows.select("uid", "t1", "t2").join(marks, ["t1", "t2"]).select("uid", "start", "end"))
    # A span within a longer one says nothing of its own.
    w = Window.partitionBy("uid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    more = (more.withColumn("reached", F.max("end").over(w))
            .where("reached is null or reached < end").groupBy("uid").agg(F.collect_list(F.struct(
                F.lit("context").alias("kind"), "start", "end")).alias("extra")))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    both = F.concat("base", F.coalesce("extra", F.array().cast(S.SPANS)))
    keyed = F.transform(both, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"),
                                                 s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("uid", "doc_id", "base").join(staged(more, "extra"), "uid", "left").select(
        "doc_id", "base", spans.cast(S.SPANS).alias("spans"))
