import random
from collections import defaultdict

from tests.llm.cases import ascii_lower, docs, odd_rows
from tidemark.llm.line_dedup import dedup_lines

LICENSE = "Permission is hereby granted, free of charge"


def brute(rows, min_chars=20, min_docs=3):
    keys = [[ascii_lower(line).strip(" \t\n\x0b\x0c\r") for line in (t or "").split("\n")] for _, t in rows]
    held, keep = defaultdict(set), {}
    for (i, _), ks in zip(rows, keys):
        for k in set(ks):
            held[k].add(i)
            if i is not None:
                keep[k] = max(keep.get(k, i), i)
    out = []
    for (i, t), ks in zip(rows, keys):
        lines = (t or "").split("\n")
        gone = [len(k) >= min_chars and len(held[k]) >= min_docs and keep.get(k) != i for k in ks]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=str)


def check(spark, rows):
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)
    return got


def test_hot_line_copies_and_odd_rows(spark):
    rng = random.Random(2)
    rows = odd_rows(2000)
    for i in range(100, 160):
        lines = [f"line {rng.randrange(40)} that is long enough to count" for _ in range(rng.randrange(1, 9))]
        if i % 3 == 0:
            lines.insert(0, f"  {LICENSE.upper() if i % 2 else LICENSE}\t")
        rows.append((i, "\n".join(lines)))
    rows += [(200, LICENSE + "\n" + LICENSE), (200, LICENSE), (None, LICENSE), (300, "short line\n" * 3)]
    check(spark, rows)


def test_only_null_ids_keep(spark):
    got = check(spark, [(None, LICENSE + "\nx")] * 3)
    assert {r[3] for r in got} == {0}
    got = check(spark, [(None, LICENSE)] * 3 + [(1, LICENSE), (2, LICENSE)])
    assert sorted(r[3] for r in got) == [0, 1, 1, 1, 1]


def test_repeated_rows_are_one_document(spark):
    for rows in ([(1, LICENSE)] * 2 + [(2, LICENSE)], [(1, LICENSE), (1, LICENSE + "\nmore"), (2, LICENSE), (2, "x")]):
        assert {r[3] for r in check(spark, rows)} == {0}
    got = check(spark, [(1, LICENSE)] * 2 + [(2, LICENSE), (3, LICENSE), (3, "and\n" + LICENSE)])
    assert sorted((r[0], r[3]) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 0), (3, 0)]


def test_sql_agrees_on_repeated_rows(spark):
    import hashlib

    import duckdb

    from tidemark.llm.sql import SQL

    rng = random.Random(6)
    texts = ["\n".join(f"a line of more than twenty {rng.randrange(9)}" for _ in range(rng.randrange(4))) for _ in range(40)]
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *texts])) for _ in range(60)]
    got = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in check(spark, rows)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(SQL["op1_line_dedup"]).fetchall(), key=str) == sorted(got, key=str)


def test_threshold_counts_documents_not_lines(spark):
    got = check(spark, [(1, "\n".join([LICENSE] * 5)), (2, LICENSE), (3, "é" * 19), (4, "é" * 19), (5, "é" * 19),
                        (6, "é" * 20), (7, "é" * 20), (8, "é" * 20)])
    assert {r[0]: r[3] for r in got} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1, 8: 0}


def test_empty_table_and_columns(spark):
    out = dedup_lines(docs(spark, []))
    assert out.collect() == [] and out.columns[:2] == ["doc_id", "text"] and "score" in out.columns
