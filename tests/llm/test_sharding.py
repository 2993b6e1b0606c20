import zlib
from collections import Counter, defaultdict

from tests.llm.cases import docs, odd_rows
from tidemark.llm.sharding import shard


def check(spark, rows, shards):
    out = shard(docs(spark, rows), shards).collect()
    assert len(out) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(((len((t or "").encode())) + 16, zlib.crc32((t or "").encode())))
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.size, r.text_crc32))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    counts = Counter(r.shard for r in out)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    where = defaultdict(set)
    for r in out:
        where[r.size, r.text_crc32].add(r.shard)
    groups = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    return {k: (groups[k], len(where[k])) for k in groups if groups[k] > 1}


def test_groups_stay_together_and_a_hot_one_is_split(spark):
    rows = odd_rows(500)
    rows += [(1000 + i, f"text {i // 3}") for i in range(300)] + [(5000 + i, "hot") for i in range(200)]
    groups = check(spark, rows, 10)
    split = [g for g in groups.values() if g[0] < 20 and g[1] > 1]
    assert len(split) <= 3
    assert [g[1] for g in groups.values() if g[0] == 200][0] <= 9


def test_everything_linked_or_few_rows(spark):
    check(spark, [(i, f"t{i % 40}") for i in range(400)], 7)
    check(spark, [(i, "same") for i in range(100)], 6)
    check(spark, [(1, "a"), (2, "a"), (3, None)], 40)


def test_empty_table(spark):
    assert shard(docs(spark, []), 4).collect() == []
