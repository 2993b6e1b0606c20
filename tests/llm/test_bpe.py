import random

import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import docs, odd_rows, prose
from tidemark.llm import bpe

ALPHABET = ["a", "b", "th", "ing", "The", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "'", "1", "23", "!", "--", "...", "_",
            "é", "ß", "á", "中", "文", "ด", "٣", "Ⅷ", "²", "🙂", "\r\n", "\x00", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​",
            "՘", "Ɤ", "\U000105c0", "\U00010940", "<|endoftext|>", "<|endof", "text|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(P.path(bpe.VOCABULARY), P.PATTERN)


def same(own, library, texts):
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert [own.decode(x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_odd_texts_as_the_library(own, library):
    rng = random.Random(12)
    same(own, library, ["".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(6000)])
    same(own, library, ["", " ", "\n", "a", "a" * 3001, "ab" * 2000, " " * 4097, " " * 4097 + "x", "x" + "\n" * 999 + " y"])


def test_every_character_as_the_library(own, library):
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200)]]
    rng = random.Random(13)
    same(own, library, [f"a{c}1{c}!{c}{c} {c}" for c in rng.sample(every, 8000)])
    for i in range(0, len(every), 20_000):
        text = "".join(f"a{c}1{c}!" for c in every[i:i + 20_000])
        words = library.pre_tokenizer.pre_tokenize_str(text)
        assert own.split(text) == [text[a:b] for _, (a, b) in words]


def test_words_meet_again_in_other_texts(own, library):
    rng = random.Random(14)
    words = [prose(rng, 1) for _ in range(300)] + ["the", "theme", "x-ray", "don't", "Ünï"]
    for _ in range(3):
        same(own, library, [rng.choice(["", " "]) + rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=200))
                            for _ in range(50)])


def test_forgetting_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    test_words_meet_again_in_other_texts(own, library)


def test_both_ways_of_merging_agree(own, monkeypatch):
    rng = random.Random(15)
    words = ["".join(rng.choices("aabeht", k=rng.randrange(1, 60))).encode() for _ in range(500)] + [b"a" * 999]

    def merged():
        index = bpe.PairIndex(words, own)
        index.apply()
        return index.ids()

    found = []
    for many in (0, 10 ** 9):
        monkeypatch.setattr(bpe, "MANY", many)
        found.append(merged())
    assert found[0] == found[1]


def test_unknown_and_broken_ids(own, library):
    rng = random.Random(16)
    for _ in range(500):
        ids = [rng.randrange(50_300) for _ in range(rng.randrange(30))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_table_of_odd_rows(spark, library, monkeypatch):
    rows = odd_rows(4000) + [(20, "x" * 300_000), (21, "<|endoftext|> a<|endoftext|>")]
    table = docs(spark, rows)
    out = bpe.decode(bpe.encode(table.withColumnRenamed("n", "ids").withColumnRenamed("key", "decoded"))).collect()
    assert out[0].__fields__ == ["doc_id", "text", "value", "spans", "score", "n_chars", "ids", "decoded"]
    got = sorted(((r.doc_id, r.ids, r.decoded, r.text) for r in out), key=str)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t) for i, t in rows]
    assert got == sorted(((i, x, library.decode(x, skip_special_tokens=False), t) for i, x, t in want), key=str)
    assert bpe.decode(bpe.encode(docs(spark, []), keep_text=False)).collect() == []
    lists = spark.createDataFrame([(None,), ([],), ([None, 64, 99_999],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(lists).collect()) == ["", "", "a"]


def test_columns_of_lists_decode_as_lists_do():
    own = bpe._bpe(None)
    top = own.width
    rows = [[1, None, -5, 10**9, 260], None, [], [top - 2, top - 1, top, 50], list(range(3000))]
    lists = pa.array([[9, 9], *rows, [9]], pa.list_(pa.int32())).slice(1, len(rows))
    assert own.decode_lists(lists) == [own.decode(x or []) for x in rows]
    assert own.decode_lists(lists.slice(0, 0)) == []
