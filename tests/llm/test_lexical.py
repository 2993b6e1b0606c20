import math
import random
import re
from collections import Counter

import pytest

from tests.llm.cases import ascii_lower, docs, near, odd_rows, prose
from tidemark.llm import lexical

ITEMS = "item_id long, text string, rank string, score string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def brute(rows, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in rows]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def answer(spark, rows, items, **how):
    table = spark.createDataFrame([(i, t, "r", "s") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical.ranked(docs(spark, rows), table, **how).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randrange(3, 40))) for i in range(12)]
    rows = odd_rows(3000) + [(100 + i, prose(rng, rng.randrange(1, 200))) for i in range(300)]
    rows += [(500 + i, near(items[i % 12][1], rng, 0.2) + " " + prose(rng, 30)) for i in range(120)]
    rows += [(700 + i, items[3][1]) for i in range(30)] + [(705, items[3][1])]
    rows += [(800, "Straße straße STRASSE Été É 12a 12A x_y a`b{c}d"), (801, "straße 12a\x7fx")]
    items += [(50, None), (51, ""), (52, "!?"), (53, "STRASSE straße 12A x y"), (None, "abc one"), (3, items[3][1]),
              (4, "tie"), (55, "nowhere to be found"), (56, " ".join(t for _, t in items))]
    return rows, items


def test_equals_brute_force(spark, corpus):
    rows, items = corpus
    assert answer(spark, rows, items) == brute(rows, items)
    # small buckets, few seeds and several blocks
    assert answer(spark, rows, items, bucket_entries=2000, seeds=5, block_bytes=4000) == brute(rows, items)
    assert answer(spark, rows, items, k=2, bucket_entries=500) == brute(rows, items, 2)


def test_buckets_are_pruned(spark, corpus):
    rows, items = corpus
    rng = random.Random(9)
    texts = [prose(rng, 40).encode() for _ in range(400)]
    queries = lexical.Queries([texts[7]])
    number = spark.sparkContext.broadcast(queries.number)
    table = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    vectors = lexical._vectors(table, number)
    import numpy as np
    weights = np.full(len(queries.number), 1000, "i8")
    batches = lexical._impacts(vectors, weights, 400, 16000).coalesce(1).toArrow().to_batches()
    bucket = lexical.Bucket([b for b in batches if b.num_rows], len(queries.number))
    terms = queries.terms[0]
    weight_of = weights.copy()
    scores = bucket.scores(np.arange(len(bucket.norms)), weight_of)
    best = int(scores.max())
    left = bucket.survivors(terms, weights, best // 2)
    assert set(np.flatnonzero(scores >= best // 2)) <= set(left) and len(left) < len(bucket.norms) / 4


def test_terms_in_every_document_and_empty_tables(spark):
    same = [(i, "common words") for i in range(2000)] + [(5000, "common rare")]
    items = [(1, "common"), (2, "rare words"), (3, "rare")]
    assert answer(spark, same, items) == brute(same, items)
    assert answer(spark, [], items) == []
    assert answer(spark, [(1, None), (2, "..")], items) == []
    assert answer(spark, same, []) == []
    assert answer(spark, same, [(1, None)]) == []


def test_very_long_text(spark):
    rows = [(1, "alpha beta " * 200_000), (2, "alpha"), (3, "gamma " * 10)]
    items = [(1, "alpha"), (2, "beta gamma")]
    assert answer(spark, rows, items) == brute(rows, items)
