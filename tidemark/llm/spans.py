"""Typed text spans: kind, start and end in code points, end exclusive."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]

#: Spark and Arrow types of a column of spans.
SPANS = "array<struct<kind:string,start:int,end:int>>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def column(rows: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows], ARROW)


def ordered(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By start, then by kind as listed, then by end."""
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def text_of(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
