"""Odd rows that every operator has to take, and brute-force helpers."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, n string, key string, value string, spans string, score string, n_chars long"


def docs(spark, rows):
    """rows of (doc_id, text), with extra columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "n", "key", "value", "spans", "score", None if t is None else len(t)) for i, t in rows], DOCS)


def odd_rows(long_words: int = 20_000):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x"]) + str(rng.randrange(900))
                    for _ in range(long_words))
    return [(1, None), (2, ""), (3, "  \n \t"), (4, "one"), (5, long), (6, "Ünï çode ÄÖ\nline two"),
            (None, "a row without an id, of some length\nsecond line of it"), (7, "tie"), (8, "tie"),
            (9, "same row"), (9, "same row"), (10, "\x00\x01 control \x7f")]


def near(text: str, rng: random.Random, share: float = 0.01) -> str:
    words = text.split(" ")
    for _ in range(max(1, int(share * len(words)))):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
