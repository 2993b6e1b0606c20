import hashlib
import random
import re

from tests.llm.cases import ascii_lower, docs, odd_rows
from tidemark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def brute(rows, items, window):
    wins = set()
    for k, t in items:
        ws = words(t) if k is not None else []
        size = min(window, len(ws))
        wins |= {(k, tuple(ws[i:i + size])) for i in range(len(ws) - size + 1) if size}
    out = []
    for i, t in rows:
        ws, hit, keys = words(t), set(), set()
        for k, w in wins:
            for p in range(len(ws) - len(w) + 1):
                if tuple(ws[p:p + len(w)]) == w:
                    hit |= set(range(p, p + len(w)))
                    keys.add(str(k))
        out.append((i, len(ws), len(hit), len(keys), hashlib.sha256(",".join(sorted(keys)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def test_equals_brute_force_in_one_block_and_in_several(spark):
    rng = random.Random(12)
    letters = ["a", "B", "c", "dé", "7"]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 9)))) for i in range(12)]
    items += [(3, "a a a a a a"), (100, None), (None, "c c c c"), (20, "a B c, dé!"), (21, "A b C dé 7 a b"), (22, "")]
    rows = odd_rows(300) + [(100 + i, " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))))
                            for i in range(40)]
    table = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, spans string")
    for window, block in ((4, 1 << 20), (4, 60), (2, 1 << 20)):
        got = [tuple(r)[:6] for r in D.contamination(docs(spark, rows), table, window, block).collect()]
        assert sorted(got, key=str) == brute(rows, items, window), (window, block)


def test_blocks_are_passes_of_their_own(spark):
    items = [(i, f"item {i} has words of its own w{i}a w{i}b") for i in range(12)]
    rows = [(i, f"before {t} after {items[i - 1][1]}") for i, t in items] + [(99, None), (98, "none"), (3, "none"), (97, items[4][1])] * 2
    table = spark.createDataFrame(items, "item_id long, text string")
    found = D.contamination(docs(spark, rows), table, 4, 60)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted([tuple(r)[:6] for r in found.collect()], key=str) == brute(rows, items, 4)


def test_automaton_finds_the_longest_match():
    rng = random.Random(13)
    for _ in range(200):
        items = [(str(i), [rng.choice([b"a", b"b"]) for _ in range(rng.randrange(1, 12))]) for i in range(3)]
        automaton = D.SuffixAutomaton(items, 4)
        held = {tuple(ws[a:b]) for _, ws in items for a in range(len(ws)) for b in range(a + 1, len(ws) + 1)}
        text = [rng.choice([b"a", b"b"]) for _ in range(30)]
        state = matched = 0
        for i, w in enumerate(text):
            if w not in automaton.words:
                state = matched = 0
                continue
            state, matched = automaton.advance(state, matched, automaton.words[w])
            longest = max((n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in held), default=0)
            assert matched == longest


def test_removes_spans_and_whole_documents(spark):
    item = "one two three four five six seven eight nine ten eleven"
    filler = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"Before it, {item.upper()}! After it. {filler}"), (2, f"{item} end"), (3, filler), (4, None), (5, ""),
            (6, f"é {item}\n{filler} {item}"), (7, "one two three four five six seven eight nine")]
    table = spark.createDataFrame([(1, item), (2, "")], "item_id long, text string")
    out = {r.doc_id: r for r in D.remove_spans(docs(spark, rows), table).collect()}
    assert {i: r.text for i, r in out.items()} == {
        1: f"Before it, ! After it. {filler}", 3: filler, 4: None, 5: "", 6: f"é \n{filler} ", 7: rows[6][1]}
    assert out[1].n_chars == len(out[1].text) and out[4].n_chars is None and out[3].spans == "spans"


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    got = D.contamination(docs(spark, [(1, "a b")]), items).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 2, 0, 0)] and not got[0].contaminated
    assert D.contamination(docs(spark, []), items).collect() == []
