import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import docs, odd_rows, prose
from tidemark.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(spark, tokenizer, rows, size=2048, **how):
    out = packing.pack(docs(spark, rows), size, **how).collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        want[i] += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for v in places.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:])) and v[-1][0] + v[-1][1] <= size
    return len(places), sum(r.length for r in out)


def test_pieces_are_those_of_the_tokenizer_and_pack_tightly(spark, tokenizer):
    rng = random.Random(20)
    rows = odd_rows(3000) + [(100 + i, prose(rng, rng.randrange(1, 300))) for i in range(400)]
    rows += [(600, "<|endoftext|> a <|endoftext|>"), (601, " " * 9000 + "x"), (602, "\n" * 5000), (603, "a\r\n\tb  c")]
    sequences, total = check(spark, tokenizer, rows)
    assert sequences <= 1.02 * -(-total // 2048) + 1
    check(spark, tokenizer, rows, size=64, group_pieces=50)


def test_same_ids_on_the_given_texts(spark, tokenizer):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    bpe = packing.ByteBpe(None)
    for t in texts:
        assert bpe.ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_best_fit_equals_brute_force():
    rng = random.Random(21)
    for _ in range(200):
        size = rng.choice([7, 16, 100])
        lengths = sorted((rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 60))), reverse=True)
        seqs, offsets = packing.best_fit(lengths, size)
        room: list[int] = []
        for n, s, o in zip(lengths, seqs, offsets):
            fits = [r for r in room if r >= n]
            if fits:
                assert room[s] == min(fits)
            else:
                assert s == len(room)
                room.append(size)
            assert o == size - room[s]
            room[s] -= n


def test_ids_and_empty_table(spark, tokenizer):
    r = packing.pack(docs(spark, [(1, "hello there")]), with_ids=True).collect()[0]
    assert r.ids == tokenizer.encode("hello there").ids + [0]
    assert packing.pack(docs(spark, [])).collect() == []
