"""Secret scans: patterns, and a linear-chain conditional random field.

The patterns give the base spans.  The field tags tokens as secret begin,
inside or outside from their shape, neighbouring words and features of the
file, decoded by Viterbi, and adds the spans that no pattern names.  It is
trained on a bounded sample of texts, whose base spans are its labels.

Plain words are outside by constraint: the chain is cut at them, so it is
decoded exactly on the short runs between, and prose costs next to nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batched

from tidemark.llm import spans as S

#: The kinds and their patterns, in order.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Marks of a word that isn't plain, and the words around it that share its run.
_ODD = re.compile(r"[0-9=:_/+]|[a-z][A-Z]")
_SPACE = re.compile(r"\s")
_NEXT = re.compile(r"\s*\S*")
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
OUT, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str) -> list[S.Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of at least 24 is the same match as a longer-than-23 match of any run.
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return S.ordered(found, KINDS)


def runs(text: str) -> list[tuple[int, int]]:
    """Stretches of odd words, each with a whole plain word on both sides."""
    out: list[tuple[int, int]] = []
    at, size = 0, len(text)
    while (m := _ODD.search(text, at)) is not None:
        begin = m.start()
        while begin and not text[begin - 1].isspace():
            begin -= 1
        end = _SPACE.search(text, m.end())
        end = at = end.start() if end else size
        a = begin
        for step in (str.isspace, lambda c: not c.isspace()):
            while a and step(text[a - 1]):
                a -= 1
        b = _NEXT.match(text, end).end()
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def shape(token: str) -> str:
    size = min(len(token).bit_length(), 7)
    kinds = "".join(c for c, p in (("d", any(map(str.isdigit, token))), ("u", any(map(str.isupper, token))),
                                   ("l", any(map(str.islower, token)))) if p)
    return f"{size}{kinds}" if token[0].isalnum() else token[0]


def file_features(text: str, n_runs: int) -> list[str]:
    """Of the whole text: how dense odd words are, and whether it looks like code or settings."""
    dense = min(5, int(math.log2(1 + 1000 * n_runs / (len(text) + 100))))
    return [f"dense{dense}", f"code{int('{' in text or '();' in text)}", f"set{int('=' in text)}"]


def token_features(tokens: list[tuple[str, int, int]], i: int, shapes: list[str], of_file: list[str]) -> list[str]:
    word = tokens[i][0].lower()
    glued = i > 0 and tokens[i - 1][2] == tokens[i][1]
    out = ["bias", f"s{shapes[i]}", f"g{int(glued)}{shapes[i]}"]
    if len(word) <= 12:
        out.append(f"w{word}")
    for k, name in ((i - 1, "p"), (i - 2, "q"), (i - 3, "r"), (i + 1, "n")):
        if 0 <= k < len(tokens):
            near = tokens[k][0].lower()
            out.append(f"{name}{near}" if len(near) <= 12 else f"{name}.")
            out.append(f"{name}s{shapes[k]}{shapes[i]}")
        else:
            out.append(f"{name}-")
    out += [f"{f}{shapes[i]}" for f in of_file]
    return out


def tokens_of(text: str, begin: int, end: int) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text, begin, end)]


class Field:
    """A linear-chain conditional random field over three tags."""

    def __init__(self, index: dict[str, int] | None = None):
        self.index = index or {}
        self.weights = np.zeros((len(self.index) + 1, 3))  # the last row: unknown features
        self.moves = np.zeros((3, 3))

    def emissions(self, features: list[list[str]]) -> np.ndarray:
        get, last = self.index.get, len(self.index)
        return np.array([self.weights[[get(f, last) for f in fs]].sum(axis=0) for fs in features])

    def _allowed(self) -> np.ndarray:
        moves = self.moves.copy()
        moves[OUT, INSIDE] = -1e9  # inside only follows begin or inside
        return moves

    def decode(self, emissions: np.ndarray) -> list[int]:
        """Viterbi; a run begins and ends among plain words, so outside."""
        moves = self._allowed().tolist()
        rows = emissions.tolist()
        best = [moves[OUT][t] + rows[0][t] for t in range(3)]
        back = []
        for e in rows[1:]:
            came, new = [], []
            for t in range(3):
                options = [best[s] + moves[s][t] for s in range(3)]
                s = max(range(3), key=options.__getitem__)
                came.append(s)
                new.append(options[s] + e[t])
            back.append(came)
            best = new
        tag = max(range(3), key=best.__getitem__)
        out = [tag]
        for came in reversed(back):
            tag = came[tag]
            out.append(tag)
        return out[::-1]

    def fit(self, runs_: list[tuple[list[list[str]], list[int]]], rounds: int = 8, rate: float = 0.3,
            damp: float = 1e-4) -> None:
        """Gradient steps on the conditional likelihood (forward-backward)."""
        coded = [([np.array([self.index[f] for f in fs if f in self.index]) for fs in feats], tags)
                 for feats, tags in runs_]
        order = np.random.default_rng(0)
        for r in range(rounds):
            step = rate / (1 + r)
            for k in order.permutation(len(coded)):
                feats, tags = coded[k]
                emit = np.array([self.weights[f].sum(axis=0) for f in feats])
                moves = self._allowed()
                n = len(feats)
                ahead, behind = np.empty((n, 3)), np.zeros((n, 3))
                ahead[0] = emit[0] + moves[OUT]
                for i in range(1, n):
                    ahead[i] = emit[i] + np.logaddexp.reduce(ahead[i - 1][:, None] + moves, axis=0)
                for i in range(n - 2, -1, -1):
                    behind[i] = np.logaddexp.reduce(moves + emit[i + 1] + behind[i + 1], axis=1)
                total = np.logaddexp.reduce(ahead[-1])
                single = np.exp(ahead + behind - total)
                for i, (f, t) in enumerate(zip(feats, tags)):
                    grad = -single[i]
                    grad[t] += 1
                    if np.abs(grad).max() > 1e-3:
                        self.weights[f] += step * grad
                    if i:
                        pair = np.exp(ahead[i - 1][:, None] + moves + emit[i] + behind[i] - total)
                        self.moves -= step * pair
                        self.moves[tags[i - 1], t] += step
                self.weights *= 1 - step * damp


def _tags(tokens: list[tuple[str, int, int]], secrets: list[tuple[int, int]]) -> list[int]:
    tags, within = [], None
    for _, a, b in tokens:
        hit = next((s for s in secrets if s[0] <= a and b <= s[1]), None)
        tags.append(OUT if hit is None else INSIDE if hit == within else BEGIN)
        within = hit
    return tags


def _values(text: str) -> list[tuple[int, int]]:
    """The secrets proper of the base spans, without what they are assigned to."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(a, b) for k, a, b in base_spans(text) if k != "assign"]
    return [s for s in set(out) if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in out)]


def train(docs: DataFrame, sample_docs: int = 20_000, most_runs: int = 6_000, least_seen: int = 3) -> Field:
    """A field learned from the base spans of about ``sample_docs`` texts, drawn
    by a hash of id and text; ``most_runs`` runs at most are fitted, half of
    them with a secret as far as there are any."""
    rows = batched(docs).select("doc_id", "text").where(F.col("text").isNotNull())
    count = max(1, docs.count())
    if count > sample_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) < int(
            (1 << 20) * sample_docs / count))

    def extract(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column(1).to_pylist():
                found = runs(text)
                of_file, values = " ".join(file_features(text, len(found))), _values(text)
                for a, b in found:
                    tokens = tokens_of(text, a, b)
                    if not 0 < len(tokens) <= 200:
                        continue
                    tags = _tags(tokens, values)
                    out[0].append(text[a:b])
                    out[1].append(of_file)
                    out[2].append("".join(map(str, tags)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], ["run", "file", "tags"])

    drawn = rows.mapInArrow(extract, "run string, file string, tags string").dropDuplicates()
    drawn = drawn.withColumn("h", F.xxhash64("run", "file"))
    parts = [drawn.where(c).orderBy("h", "run", "file").limit(most_runs // 2).collect()
             for c in (F.col("tags").contains("1"), ~F.col("tags").contains("1"))]
    prepared = []
    for row in parts[0] + parts[1]:
        tokens = tokens_of(row["run"], 0, len(row["run"]))
        shapes, of_file = [shape(t[0]) for t in tokens], row["file"].split()
        prepared.append(([token_features(tokens, i, shapes, of_file) for i in range(len(tokens))],
                         [int(c) for c in row["tags"]]))
    seen = Counter(f for feats, _ in prepared for fs in feats for f in fs)
    field = Field({f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least_seen))})
    field.fit(prepared)
    return field


def field_spans(field: Field, text: str, base: list[S.Span], least_chars: int = 6) -> list[S.Span]:
    """Spans that the field tags and that no base span meets."""
    found = runs(text)
    if not found:
        return []
    of_file, out = file_features(text, len(found)), []
    for a, b in found:
        tokens = tokens_of(text, a, b)
        if not tokens:
            continue
        shapes = [shape(t[0]) for t in tokens]
        tags = field.decode(field.emissions([token_features(tokens, i, shapes, of_file) for i in range(len(tokens))]))
        open_span = None
        for (_, start, end), tag in zip(tokens, tags):
            if tag == INSIDE and open_span and open_span[1] == start:
                open_span = (open_span[0], end)
                continue
            if open_span:
                out.append(open_span)
            open_span = (start, end) if tag != OUT else None
        if open_span:
            out.append(open_span)
    return [("crf", a, b) for a, b in out if b - a >= least_chars
            and not any(a < y and x < b for _, x, y in base)]


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, base and spans (base ones
    and the field's), both as arrays of (kind, start, end) in order.

    Whole texts are searched; null and empty ones have no span.  Every row is a
    document: repeated rows and null ids come out as they came in.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the sample

    def run(batches):
        for batch in batches:
            base, every = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                own = base_spans(text)
                base.append(own)
                every.append(S.ordered(own + field_spans(shared.value, text, own), KINDS))
            yield pa.RecordBatch.from_arrays([batch.column(0), S.column(base), S.column(every)],
                                             ["doc_id", "base", "spans"])

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, base {S.SPANS}, spans {S.SPANS}")
