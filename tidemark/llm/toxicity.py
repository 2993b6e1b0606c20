"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Texts are folded (case, homoglyphs, digit substitutions, invisible marks), so
that a disguised spelling meets the plain entry.  Entries are whole words and
word beginnings with log-odds weights learned from labelled rows.  A word of
the text counts with its heaviest entry, unless an exception phrase covers it.
The sum, its value by length and the heaviest word make the score, by a
logistic function fitted on rows that the weights have not seen.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batched, staged

#: Look-alike letters, digit and sign substitutions, and marks
#: that don't show.  l, i and 1 are one class, as 1 stands for either.
HOMOGLYPHS = dict(zip("аеорсухікмтнвѕјԁɡαοειυκρντ", "aeopcyxikmthbsjdgaoeiukpvt"))
SUBSTITUTES = {"0": "o", "1": "i", "l": "i", "|": "i", "3": "e", "4": "a", "5": "s", "7": "t",
               "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
_FOLD = str.maketrans(HOMOGLYPHS | SUBSTITUTES | dict.fromkeys(INVISIBLE))
_WORD = re.compile(r"[^\W_]+")
#: Scripts that are written without blanks between words (Thai to
#: Lao, Tibetan to Myanmar, Khmer, kana, Han).
_UNSPACED = "\u0e00-\u0eff\u0f00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_RUN = re.compile(f"[{_UNSPACED}]+")
#: Lengths of the entries inside such text.
GRAMS = range(2, 5)
#: Lengths of the word beginnings that may become entries.
PREFIXES = range(4, 10)


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


def terms_of(folded: str) -> set[str]:
    """Whole words (closed by a blank) and word beginnings of a folded text, and
    the short runs of letters of scripts that have no blanks."""
    words = set(_WORD.findall(folded))
    out = {w + " " for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) > n}
    if not folded.isascii():
        out |= {r[i:i + n] for r in _RUN.findall(folded) for n in GRAMS for i in range(len(r) - n + 1)}
    return out


def _apart(text: str, at: int) -> bool:
    """Whether a word may end before the character at ``at`` and begin there."""
    a, b = text[at - 1], text[at]
    return not (a.isalnum() and b.isalnum()) or bool(_RUN.match(a) or _RUN.match(b))


@dataclass
class Lexicon:
    """Weights by term, exception phrases, and the logistic function's factors."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    factors: list[float] = field(default_factory=lambda: [-3.0, 1.0, 0.5, 1.0])

    def matcher(self):
        import ahocorasick

        entries: dict[str, list] = {}
        for term, w in self.weights.items():
            entries.setdefault(term.strip(), [None, None, False])[term.endswith(" ")] = w
        for phrase in self.exceptions:
            entries.setdefault(phrase, [None, None, False])[2] = True
        if not entries:
            return None
        out = ahocorasick.Automaton()
        for key, (begin, whole, phrase) in entries.items():
            out.add_word(key, (len(key), begin, whole, phrase))
        out.make_automaton()
        return out


def hits(matcher, folded: str) -> dict[int, float]:
    """Weight by place of each word with an entry, less those in exceptions."""
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    last = len(folded)
    for end, (size, begin, whole, phrase) in matcher.iter(folded) if matcher else ():
        start = end + 1 - size
        if start and not _apart(folded, start):
            continue
        closed = end + 1 == last or _apart(folded, end + 1)
        w = max((x for x in (begin, whole if closed else None) if x is not None), default=None)
        if w is not None:
            found[start] = max(w, found.get(start, w))
        if phrase and closed:
            spared.append((start, end))
    for a, b in spared:
        for at in [x for x in found if a <= x <= b]:
            del found[at]
    return found


def features(matcher, text: str | None) -> tuple[float, float, float]:
    folded = fold(text or "")
    found = hits(matcher, folded)
    if not found:
        return 0.0, 0.0, 0.0
    total = sum(found.values())
    return math.log1p(total), math.log1p(1000 * total / (len(folded) + 100)), max(found.values())


_MATCHERS: dict = {}


def _matcher(shared):
    if shared.id not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[shared.id] = shared.lexicon.value.matcher()
    return _MATCHERS[shared.id]


class _Shared:
    """A lexicon on the executors; the automaton is built once a worker, which
    knows it by an id that no other lexicon ever has."""

    def __init__(self, spark, lexicon: Lexicon):
        self.lexicon = spark.sparkContext.broadcast(lexicon)
        self.id = uuid.uuid4().hex


def fold_of(doc_id) -> F.Column:
    """crc32(doc_id as text) mod 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def _training(docs: DataFrame, labels: DataFrame, max_training: int) -> DataFrame:
    """At most ``max_training`` labelled rows outside the held-out fold, one for
    each group of near copies: fold, toxic, folded text."""
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .withColumn("fold", fold_of("doc_id")).where("fold <> 0")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training))
    rows = batched(docs).select("doc_id", "text").where(F.col("text").isNotNull()) \
        .join(F.broadcast(chosen), "doc_id")  # max_training rows of two numbers

    def prepare(batches):
        for batch in batches:
            texts = [fold(t) for t in batch.column(0).to_pylist()]
            marks = []
            for t in texts:
                ws = _WORD.findall(t)
                marks.append(min((zlib.crc32(" ".join(ws[i:i + 3]).encode("utf-8", "replace"))
                                  for i in range(max(1, len(ws) - 2))), default=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts), batch.column(1), batch.column(2), pa.array(marks, pa.int64())],
                ["text", "toxic", "fold", "mark"])

    prepared = rows.select("text", F.col("toxic").cast("int"), F.col("fold").cast("int")).mapInArrow(
        prepare, "text string, toxic int, fold int, mark long")
    return staged(prepared.dropDuplicates(["mark", "toxic"]), "toxicity-training")


def _counts(rows: DataFrame, of) -> DataFrame:
    """Sum over rows of the keys that ``of(text)`` names, combined per batch."""

    def count(batches):
        for batch in batches:  # a batch is small, and so is its count
            total: Counter = Counter()
            for t in batch.column(0).to_pylist():
                total.update(of(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["key", "n"])

    return rows.select("text").mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, max_training: int = 50_000,
          share: float = 0.002, least_odds: float = 7.0, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from ``labels(doc_id, toxic)``.

    Fitted on at most ``max_training`` labelled rows (by a hash of their id),
    never on those of the held-out fold.  Weights come from folds 1 to 3, the
    logistic function from fold 4.  A term needs ``share`` of the toxic rows (3
    at least), so there are at most 1/share times the terms of a text, and by
    the lower 5 % bound ``least_odds`` times its rate elsewhere; the logarithm
    of that bound is its weight.  ``exceptions`` are phrases that
    don't count; others are learned where an entry stands in untoxic rows.
    Without usable labels the lexicon is empty and all scores are equal.
    """
    rows = _training(docs, labels, max_training)
    size = {r["toxic"]: r["count"] for r in rows.where("fold < 4").groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    given = [fold(x) for x in exceptions]
    if not n1:
        return Lexicon({}, given)
    least = max(3, math.ceil(share * n1))
    toxic = _counts(rows.where("fold < 4 and toxic = 1"), terms_of).where(F.col("n") >= least)
    in_toxic = {r["key"]: r["n"] for r in toxic.collect()}
    known = docs.sparkSession.sparkContext.broadcast(frozenset(in_toxic))
    other = _counts(rows.where("fold < 4 and toxic = 0"), lambda t: terms_of(t) & known.value)
    in_other = {r["key"]: r["n"] for r in other.collect()}
    weights = {}
    for term, k in in_toxic.items():
        b = in_other.get(term, 0) + 0.5
        low = math.log((k + 0.5) / (n1 + 1) / (b / (n0 + 1))) - 1.645 * math.sqrt(1 / (k + 0.5) + 1 / b)
        if low >= math.log(least_odds):
            weights[term] = round(low, 4)
    # A longer entry that a shorter one covers with no less weight adds nothing.
    for term in sorted(weights, key=len, reverse=True):
        word = term.strip()
        if any(weights.get(word[:n], -1) >= weights[term] for n in PREFIXES if n < len(word)):
            del weights[term]
    lexicon = Lexicon(weights, given)
    lexicon.exceptions += _exceptions(rows, lexicon)
    lexicon.factors = _fit(rows, lexicon)
    return lexicon


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Word pairs with an entry that stand in untoxic rows, 3 or more, and in
    less than a quarter as many toxic ones."""
    shared = _Shared(rows.sparkSession, lexicon)

    def pairs(text: str) -> set[str]:
        out = set()
        for at in hits(_matcher(shared), text):
            word = _WORD.match(text, at)
            before = _WORD.findall(text, max(0, at - 30), at - 1) if text[at - 1:at] == " " else []
            after = _WORD.match(text, word.end() + 1) if text[word.end():word.end() + 1] == " " else None
            if before and text[at - 2].isalnum():
                out.add(f"{before[-1]} {word[0]}")
            if after:
                out.add(f"{word[0]} {after[0]}")
        return out

    kept = _counts(rows.where("fold < 4 and toxic = 0"), pairs).where("n >= 3")
    clean = {r["key"]: r["n"] for r in kept.collect()}
    if not clean:
        return []
    toxic = _counts(rows.where("fold < 4 and toxic = 1"), lambda t: pairs(t) & clean.keys())
    against = {r["key"]: r["n"] for r in toxic.collect()}
    return sorted(p for p, n in clean.items() if n > 4 * against.get(p, 0))


def _fit(rows: DataFrame, lexicon: Lexicon) -> list[float]:
    """Factors of the logistic function, by Newton steps on fold 4 (all folds
    where it lacks a label); at most ``max_training`` rows of four numbers."""
    shared = _Shared(rows.sparkSession, lexicon)

    def measure(batches):
        for batch in batches:
            m = _matcher(shared)
            found = [features(m, t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2)] + [pa.array([f[i] for f in found], pa.float64()) for i in range(3)],
                ["toxic", "fold", "a", "b", "c"])

    got = rows.select("text", "toxic", "fold").mapInArrow(
        measure, "toxic int, fold int, a double, b double, c double").toPandas()
    last = got[got["fold"] == 4]
    if last["toxic"].nunique() == 2:
        got = last
    x = np.column_stack([np.ones(len(got)), got[["a", "b", "c"]].to_numpy()])
    y = got["toxic"].to_numpy(dtype=float)
    # Entries were chosen for standing in toxic rows: more weight never lowers a score.
    beta, damp = np.zeros(4), np.diag([1e-3, 0.05, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + damp, x.T @ (y - p) - damp @ beta)
        beta = beta + step * min(1, 4 / max(1e-9, np.abs(step).max()))
        beta[1:] = np.maximum(beta[1:], 0)
    return [float(b) for b in beta]


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with added columns ``score`` (0 to 1) and ``predicted``.

    Each row is scored on its whole text alone; null and empty texts have no
    entry and get the lowest score.  Columns already so called are replaced.
    """
    shared = _Shared(docs.sparkSession, lexicon)
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    b0, b1, b2, b3 = lexicon.factors

    def run(batches):
        for batch in batches:
            m, out = _matcher(shared), []
            for text in batch.column(batch.schema.get_field_index("text")):
                f = features(m, text.as_py())
                z = b0 + b1 * f[0] + b2 * f[1] + b3 * f[2]
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield batch.append_column("score", pa.array(out, pa.float64()))

    rows = batched(docs).select(*[F.col(f"`{c}`") for c in columns])
    schema = rows.withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
