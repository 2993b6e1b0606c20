import itertools
import random
import re

import numpy as np

from tests.llm.cases import docs, odd_rows
from tidemark.llm import pii, secret_scan


def matches(pattern, text, ok):
    return [m for m in re.finditer(pattern, text) if ok(m)]


def brute_secrets(t):
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                      for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = [(m.start(), 0, "assign", m.end()) for m in matches(
        rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, lambda m: len(m[2]) >= 6)]
    found += [(m.start(), 1, "access", m.end()) for m in matches("AKIA[A-Z0-9]+", t, lambda m: len(m[0]) >= 20)]
    found += [(m.start(), 2, "hex", m.end()) for m in matches("[0-9a-f]+", t, lambda m: len(m[0]) >= 24)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def brute_pii(t):
    found = [(m.start(), 0, "email", m.end()) for m in matches(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t, bool)]
    found += [(m.start(), 1, "ip", m.end()) for m in matches(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t, lambda m: all(int(x) <= 255 for x in m[0].split(".")))]
    found += [(m.start(), 2, "card", m.end()) for m in matches(
        r"[0-9]([\x20-]?[0-9])+", t, lambda m: 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m)))]
    found += [(m.start(), 3, "phone", m.end()) for m in matches(
        r"\+[0-9][\x20().0-9-]+[0-9]", t, lambda m: 9 <= len(digits(m)) <= 15)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def noise(rng, parts, n):
    return "".join(rng.choice(parts) for _ in range(n))


def test_base_spans_of_secrets_equal_brute_force():
    rng = random.Random(4)
    parts = ["password", "PassWd", "Secret", "TOKEN", "api_key", "ApiKey", "ſecret", "toKen", "=", ":", " ", '"', "'",
             "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "é", "\n", "x", "-_./+"]
    for _ in range(3000):
        t = noise(rng, parts, rng.randrange(1, 14))
        assert secret_scan.base_spans(t) == brute_secrets(t), t


def test_base_spans_of_pii_equal_brute_force():
    rng = random.Random(5)
    parts = ["a.b", "@", "x", ".", "com", "-", "+", "1", "25", "256", "000", " ", "4111 1111 1111 1111", "(", ")", "é",
             "378282246310005", "+49 (30) 123-4567", "0", "%", "\n", "@@"]
    for _ in range(3000):
        t = noise(rng, parts, rng.randrange(1, 14))
        assert pii.base_spans(t) == brute_pii(t), t


def test_secrets_found_by_the_field(spark):
    rng = random.Random(6)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = odd_rows(3000)
    for i in range(100, 400):
        word = ["the value here", "see page 12 of it", "at 10:30 it is", "http://host.example/a/b1"][i % 4]
        rows.append((i, f"some words {word} and more words\nset password={hexes(18)} now" if i % 2 else f"plain {word} x"))
    planted = f"then set pasword={hexes(18)} now"
    rows.append((1000, planted))
    d = docs(spark, rows)
    field = secret_scan.train(d)
    got = {}
    for r in secret_scan.find(d, field).collect():
        got.setdefault(r.doc_id, []).append(([tuple(s) for s in r.base], [tuple(s) for s in r.spans]))
    for i, t in rows:
        want = brute_secrets(t or "")
        assert any(b == want and set(b) <= set(s) for b, s in got[i]), i
    extra = [t for t in got[1000][0][1] if t[0] == "crf"]
    assert extra and planted[extra[0][1]:extra[0][2]].startswith(planted[17:30])
    clean = [i for i in range(100, 400, 2) if got[i][0][1]]
    assert not clean
    assert secret_scan.find(docs(spark, []), field).collect() == []


def test_short_secrets_and_long_plain_values_come_out_whole():
    field = secret_scan.Field({"whunter2": 0, "s6l": 1})
    field.weights[:2] = [-5, 9, -5]
    text = "set pasword=hunter2 now"
    assert secret_scan.field_spans(field, text, []) == [("crf", 12, 19)]
    value = "abcdefghij" * 6
    for gap in (" ", " " * 50):
        text = f"set pasword:{gap}{value} now"
        at = text.index(value)
        assert secret_scan.runs(text) == [(0, at + 60)]
        assert ("crf", at, at + 60) in secret_scan.field_spans(field, text, [])
    assert secret_scan.runs(f"{value}  key=1") == [(0, 67)]


def test_viterbi_is_exact():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 6):
        field = secret_scan.Field()
        field.moves = rng.normal(size=(3, 3))
        e = rng.normal(size=(n, 3))
        moves = field._allowed()

        def value(tags):
            return (moves[0, tags[0]] + sum(moves[a, b] for a, b in zip(tags, tags[1:]))
                    + sum(e[i, t] for i, t in enumerate(tags)))

        best = max(itertools.product(range(3), repeat=n), key=value)
        assert tuple(field.decode(e)) == best


def test_context_patterns_discover(spark):
    rng = random.Random(8)
    rows = odd_rows(3000)
    for i in range(100, 130):
        rows.append((i, f"please write contact mail u{i}@mail.example today"))
    rows += [(200, "please write contact mail user-77-at-home today"), (201, "the user-77-at-home again")]
    rows += [(300 + i, f"page number {rng.randrange(10**6)} of the book") for i in range(40)]
    out = {}
    for r in pii.find(docs(spark, rows)).collect():
        out.setdefault(r.doc_id, []).append(([tuple(s) for s in r.base], [tuple(s) for s in r.spans]))
    for i, t in rows:
        assert any(b == brute_pii(t or "") for b, _ in out[i]), i
    assert out[200][0][1] == [("context", 26, 41)] and out[201][0][1] == [("context", 4, 19)]
    assert not any(s for i in range(300, 340) for _, s in out[i])
    assert pii.find(docs(spark, [])).collect() == []


def test_discovered_instances_are_marked_without_a_pattern(spark):
    rows = [(i, f"please write contact mail u{i}@mail.example today") for i in range(100, 130)]
    rows += [(200, "please write contact mail user-77-at-home today"), (201, "user-77-at-home again"),
             (202, "user-77-at-home"), (203, "key user-77-at-home"), (204, f"some words {'0 ' * 40}user-77-at-home {'= ' * 40}")]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs(spark, rows)).collect()}
    for i, t in rows[31:]:
        at = t.index("user-77")
        assert got[i] == [("context", at, at + 15)], i


def test_slots_discover_digit_runs_and_words_without_digits(spark):
    rows = [(100 + i, f"please write contact mail u{i}@mail.example today") for i in range(40)]
    ids = ["555 123 4567", "(555) 123-4567", "GB29 NWBK 6016 1331 9268 19", "4111 1111 1111 1112",
           "jane.doe(at)mail.com", "janedoe"]
    for n, x in enumerate(ids):
        rows += [(200 + n, f"please write contact mail {x} today"), (300 + n, f"{x} again")]
    rows += [(400, "please write contact mail later today"), (401, "we meet later or much later then"),
             (402, "come later if you can, later is fine")]
    rows += [(500 + i, f"page {i} of word {i}{i} 7 and jane of the house") for i in range(20)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(docs(spark, rows)).collect()}
    for n, x in enumerate(ids):
        assert got[200 + n] == [("context", 26, 26 + len(x))], x
        assert got[300 + n] == [("context", 0, len(x))], x
    assert not any(got[i] for i in (400, 401, 402, *range(500, 520)))


def test_slots_equal_patterns_word_by_word():
    rng = random.Random(12)
    parts = ["Aa", "b", "c.d", "ünï", "e(f)g", "--", "7", "x1", "(h", "i)", "_", "...", "\n", "Bb,", "'j k'"]
    memo = pii._Tokens()
    for _ in range(200):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        found = list(re.finditer(r"\S+", text))
        tokens = memo.table[[memo[m[0]] for m in found]] if found else np.zeros((0, 6), "u8")
        a, b, has_a, has_b = pii._slots_of(tokens)
        for i, m in enumerate(found):
            bare = m[0].strip(pii._TRIM)
            start = m.start() + len(m[0]) - len(m[0].lstrip(pii._TRIM))
            if bare:
                got = {int(x) for x, ok in ((a[i], has_a[i]), (b[i], has_b[i])) if ok}
                assert got == {pii.pattern_hash(p) % 2**64 for p in pii.patterns_of(text, start, start + len(bare))}, text
