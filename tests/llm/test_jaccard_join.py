import random
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.cases import ascii_lower, docs, near, odd_rows, prose
from tidemark.llm import jaccard_join as J
from tidemark.llm.graph import components


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent, held = list(range(len(rows))), defaultdict(list)
    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in held[g])
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(parent, i)] = find(parent, j)
        for g in s:
            held[g].append(i)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(parent, i)].append(k)
    return sorted(((k, len(s), min(least[find(parent, i)], default=None))
                   for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(rng):
    rows = odd_rows(3000) + [(20, "Same Few"), (21, "same few"), (22, "same few words"), (23, "x\ny")]
    passage = prose(rng, 60)
    at = 100
    for g in range(12):
        text = prose(rng, rng.randrange(20, 200))
        for _ in range(rng.randrange(1, 9)):
            rows.append((at, near(text, rng, rng.choice([0.003, 0.01, 0.02, 0.04]))))
            at += 1
    hot = prose(rng, 120)
    chain = hot
    for _ in range(60):
        rows.append((at, near(hot, rng, 0.005)))
        chain = near(chain, rng, 0.01)
        rows.append((at + 1, chain))
        rows.append((at + 2, passage + " " + prose(rng, rng.randrange(5, 60))))
        at += 3
    rows += [(at, hot), (at + 1, hot.upper()), (None, hot), (None, "nobody else has this one text here")]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_ROWS", 8)  # many groups, chunks and salts
    monkeypatch.setattr(J, "BUCKET_TOKENS", 200)
    monkeypatch.setattr(J, "HOT_SETS", 20)  # the shared passages are hot
    rows = corpus(random.Random(14))
    table = docs(spark, rows)
    for groupings in (0, 2):  # without groupings all links come from the matrix
        out = J.near_duplicates(table, groupings=groupings).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows)


def test_a_hot_shingle_is_spread_over_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_SETS", 100)
    rng = random.Random(16)
    passage = prose(rng, 12)
    rows = [(i, prose(rng, 30) + (" " + passage if i % 3 == 0 else "")) for i in range(1200)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)]  # copies count once
    table = docs(spark, rows)
    tokens, held = J.hot_tokens(J.document_sets(table))
    assert sorted(tokens.tolist()) == J.shingle_sets([passage])[0].tolist()
    assert held.min() >= 400
    shared = spark.sparkContext.broadcast((tokens, held))
    in_bucket = Counter()
    for r in J._bucketed(table, 64, shared).collect():
        found = np.isin(np.frombuffer(r.tokens, "<u8"), tokens)
        in_bucket[r.bucket] += int(found.sum())
    assert sum(in_bucket.values()) >= 400 * len(tokens)
    assert max(in_bucket.values()) < 3 * sum(in_bucket.values()) / 64
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(table).collect()),
                  key=str) == brute(rows)


def test_keep_first_keeps_one_of_each(spark):
    rows = corpus(random.Random(15))
    out = J.keep_first(docs(spark, rows))
    assert out.columns == docs(spark, []).columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    want = {c for _, n, c in brute(rows) if n and c is not None}
    worded = [i for i, t in got if shingles(t)]
    assert sorted(i for i in worded if i is not None) == sorted(want)
    assert worded.count(None) == 1 + sum(1 for i, t in rows if i is None and "without an id" in (t or ""))
    assert sum(not shingles(t) for _, t in got) == sum(not shingles(t) for _, t in set(rows))


def test_sets_and_bound_helpers():
    rng = random.Random(16)
    texts = [None, "", " \n", "a", "A b\tC", prose(rng, 50), "é è é è é è é è"] + [prose(rng, 7) for _ in range(20)]
    sets = J.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    alone = [J.shingle_sets([t])[0] for t in texts]
    assert all((a == b).all() for a, b in zip(sets, alone))
    for buckets in (64, 1 << 16, 1 << 20):
        assert int(J._bucket_of(sets[5], buckets).max()) < buckets


def test_different_long_words_have_different_hashes(spark):
    rng = random.Random(18)
    words = [prose(rng, 1) * rng.randrange(1, 90) for _ in range(300)]
    for n in (1024, 2048, 4096):
        even = "".join("ab"[bin(i).count("1") % 2] for i in range(n))  # sums over powers can't tell it from its complement
        words += [even, even.translate(str.maketrans("ab", "ba")), "a" * n, "a" * (n - 1) + "b"]
    sets = [tuple(s.tolist()) for s in J.shingle_sets(words)]
    assert len(set(sets)) == len(set(words))
    texts = [" ".join(words[-12:-10][i % 2] for _ in range(9)) for i in range(2)]
    got = J.near_duplicates(docs(spark, list(enumerate(texts)))).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(0, 0), (1, 1)}


def test_components_of_edges(spark):
    rng = random.Random(17)
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(parent, x) for x in linked}


def test_empty_table(spark):
    assert J.near_duplicates(docs(spark, [])).collect() == []
