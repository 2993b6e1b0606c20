import gzip
import hashlib
import os
import random

import pytest

from tidemark.llm import warc

PAGES = "page_id long, url string, html string, status string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "s", "b") for i, u, h in rows], PAGES)


def round_trip(spark, tmp_dir, rows, segment_bytes=700):
    warc.write_archives(pages(spark, rows), f"{tmp_dir}/w", segment_bytes=segment_bytes)
    return warc.payloads(warc.reassemble(warc.read_records(spark, f"{tmp_dir}/w")))


def test_round_trip_of_odd_pages(spark, tmp_dir):
    rng = random.Random(3)
    big = "".join(rng.choice("abcé\r\n<>") for _ in range(60_000))
    rows = [(1, "http://a/x y", "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"), (2, None, None), (3, "u", ""),
            (4, "u", big), (5, "u", big), (6, None, big), (None, "n", big), (7, "s", "x" * 999), (8, "s", "x" * 999),
            (9, "r", "y" * 1000), (9, "r", "y" * 1000), (10, "r", "y" * 1000)]
    out = round_trip(spark, tmp_dir, rows)
    assert {r.status for r in out.collect()} == {"ok"}
    held = {r.page_id: bytes(r.payload) for r in out.where("record_type = 'response'").collect()}
    assert held == {1: rows[0][2].encode(), 2: b"", 3: b"", 6: big.encode(), 7: b"x" * 999, 8: b"x" * 999,
                    10: b"y" * 1000}
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.status)
                  for r in warc.resolve_revisits(out.drop("payload")).collect()), key=str)
    last = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, i), i)
    want = []
    for i, _, h in rows:
        raw, first = (h or "").encode(), last.get(h)
        revisit = first is not None and first != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                     first if revisit else None, "ok"))
    assert got == sorted(want, key=str)


def test_segments_from_elsewhere_in_any_order(spark, tmp_dir):
    head, body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n", warc.chunked(b"payload" * 50, 16)
    block = head + body

    def record(name, kind, part, more):
        return warc._header(kind, name, part, more) + b"\r\n\r\n"

    def split(name, page, total, numbers):
        parts = [block[i:i + 100] for i in range(0, len(block), 100)]
        out = [record(name, "response", parts[0], [("X-Page-Id", page), ("WARC-Segment-Number", 1)])]
        for n, p in enumerate(parts[1:], 2):
            if n in numbers:
                out.append(record(f"{name}-{n}", "continuation", p, [
                    ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", n),
                    ("WARC-Segment-Total-Length", total if n == len(parts) else None)]))
        return out[::-1], len(parts)

    n = split("x", 1, 1, ())[1]
    good = split("urn:a", 1, len(block), range(2, n + 1))[0]
    gap = split("urn:b", 2, len(block), [k for k in range(2, n + 1) if k != 3])[0]
    wrong = split("urn:c", 3, len(block) + 1, range(2, n + 1))[0]
    broken = [record("urn:d", "response", head + b"zz\r\n", [("X-Page-Id", 4)])]
    lost = split("urn:e", 5, len(block), range(2, n + 1))[0][:-1]
    files = [good[:2] + gap, good[2:] + wrong + broken + lost]
    folder = f"{tmp_dir}/f"
    rows = [(i, gzip.compress(b"".join(f[:1])) + gzip.compress(b"".join(f[1:]))) for i, f in enumerate(files)]
    os.makedirs(folder)
    for i, raw in rows:
        with open(f"{folder}/{i}.warc.gz", "wb") as out:
            out.write(raw)
    out = warc.payloads(warc.reassemble(warc.read_records(spark, folder)))
    got = {r.page_id: (r.status, r.payload and bytes(r.payload)) for r in out.collect()}
    assert got == {1: ("ok", b"payload" * 50), 2: ("gap", None), 3: ("length", None), 4: ("framing", None),
                   None: ("gap", None)}


def written(folder, files):
    os.makedirs(folder)
    for i, raw in enumerate(files):
        with open(f"{folder}/{i}.warc", "wb") as out:
            out.write(raw)
    return folder


def plain(page, body, **more):
    head = b"HTTP/1.1 200 OK\r\n\r\n"
    return warc._header("response", f"urn:{page}", head + body, [("X-Page-Id", page)]) + b"\r\n\r\n"


def test_broken_archives_are_rows_with_a_status(spark, tmp_dir):
    good = [plain(i, b"body %d" % i) for i in range(6)]
    no_length = b"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 50\r\n\r\nabc\r\n\r\n"
    odd_length = no_length.replace(b"50\r\n", b"51\r\nContent-Length: many\r\n")
    damaged = bytearray(gzip.compress(b"".join(good[2:4])))
    damaged[len(damaged) // 2] ^= 0xFF
    damaged[len(damaged) // 2 + 1] ^= 0xFF
    long = gzip.compress(plain(61, os.urandom(200_000)))
    files = [good[0] + no_length + odd_length + good[1],
             gzip.compress(plain(60, b"before")) + bytes(damaged) + gzip.compress(good[4]),
             gzip.compress(good[5]) + long[:-100_000],
             plain(70, b"whole") + plain(71, b"x" * 5000)[:-1000], b"", b"no archive at all", gzip.compress(b"")]
    records = warc.read_records(spark, written(f"{tmp_dir}/b", files))
    found = [(r.page_id, r.status) for r in records.collect()]
    seen = {p: s for p, s in found if p is not None}
    assert {seen[p] for p in (0, 1, 4, 5, 60, 70)} == {"ok"}
    assert {p: s for p, s in seen.items() if s != "ok" and p not in (2, 3)} == {
        50: "header", 51: "header", 61: "cut", 71: "cut"}
    assert sum(s == "damaged" for _, s in found) == 2  # a flipped byte, a member cut short
    out = warc.payloads(warc.reassemble(records)).collect()
    assert len(out) == len(found)
    assert {(r.page_id, bytes(r.payload)) for r in out if r.status == "ok" and r.page_id in (0, 1, 4, 5)} == {
        (i, b"body %d" % i) for i in (0, 1, 4, 5)}
    assert {r.payload for r in out if r.status != "ok"} == {None}
    digests = warc.payloads(warc.reassemble(records), with_payload=False)
    assert "payload" not in digests.columns
    assert sorted((str(r.payload_digest), r.status) for r in digests.collect()) == sorted(
        (str(r.payload_digest), r.status) for r in out)


def test_a_cut_segment_is_no_whole_record(spark, tmp_dir):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"z" * 300
    parts = [warc._header("response", "urn:o", block[:100], [("X-Page-Id", 1), ("WARC-Segment-Number", 1)]),
             warc._header("continuation", "urn:p", block[100:], [("WARC-Segment-Origin-ID", "<urn:o>"), ("WARC-Segment-Number", 2),
                                                                 ("WARC-Segment-Total-Length", len(block))])]
    files = [parts[0] + b"\r\n\r\n", parts[1][:-50]]
    out = warc.payloads(warc.reassemble(warc.read_records(spark, written(f"{tmp_dir}/c", files)))).collect()
    assert [(r.page_id, r.status, r.payload) for r in out] == [(1, "cut", None)]


def test_large_records_are_read_in_linear_time(spark, tmp_dir):
    import time

    body = os.urandom(1 << 20) * 64
    raw = plain(1, body) + plain(2, b"after")
    began = time.perf_counter()
    step = 1 << 16
    got = list(warc.parse(raw[i:i + step] for i in range(0, len(raw), step)))
    assert time.perf_counter() - began < 5
    assert [(f["x-page-id"], len(b), s) for f, b, s in got] == [("1", len(body) + 19, "ok"), ("2", 24, "ok")]
    warc.write_archives(pages(spark, [(1, "u", "ab\n" * 6_000_000)]), f"{tmp_dir}/l")
    out = warc.payloads(warc.reassemble(warc.read_records(spark, f"{tmp_dir}/l")), with_payload=False).collect()
    assert [(r.page_id, r.payload_bytes, r.status) for r in out] == [(1, 18_000_000, "ok")]


def test_chunked_framing():
    for raw in (b"", b"x", b"\r\n" * 5000):
        assert warc.unchunked(warc.chunked(raw)) == raw
    for bad in (b"", b"5\r\nab", b"g\r\n", b"2\r\nabX0\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def test_empty_table(spark, tmp_dir):
    assert round_trip(spark, tmp_dir, []).count() == 0


def test_no_aggregate_is_left_beside_the_join_on_digests(spark):
    rows = pages(spark, [(i, "u", "z" * 1000) for i in range(5)] + [(9, "v", "w")]).selectExpr(
        "page_id", "url", "cast(html as binary) html", "sha1(html) digest")
    joined = warc._with_firsts(rows, 1000)
    assert "Aggregate" not in joined._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.page_id, r.first, r.first_url, r.revisit) for r in joined.collect() if r.page_id != 9)
    assert got == [(i, 4, "u", i < 4) for i in range(5)]
    assert [(r.first, r.revisit) for r in joined.collect() if r.page_id == 9] == [(None, False)]
