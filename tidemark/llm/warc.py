"""WARC archives: write pages, read them back, put segments together.

Payloads are stored in chunked transfer framing; records over a size limit are
segmented.  On reading, continuation records are grouped by the id of their
origin, ordered by segment number and held against the total length before
the chunked framing is decoded.

Archives are written by Spark's text writer with the record end as its line
separator, so output is committed task by task and a lost executor leaves no
half archive behind.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batched, staged

RECORD_END = "\r\n\r\n"
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 4096
#: Records in an archive, so that a reader's task holds a few MB at once.
FILE_RECORDS = 2000
RECORD = ("archive string, record_type string, record_id string, origin_id string, segment int, "
          "total_length long, page_id long, target string, digest string, refers_to long, block binary, status string")
#: Bytes of blocks or payloads in a batch that a task sends on.
BATCH_BYTES = 4 << 20
GZIP = b"\x1f\x8b\x08"


def _header(kind: str, record_id: str, block: bytes, more: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in more if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in
             (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at:at + size])
        at += size + 2


def records_of(page_id: int | None, url: str | None, html: bytes, digest: str, first: int | None,
               first_url: str | None, revisit: bool, segment_bytes: int) -> Iterator[bytes]:
    """The WARC records of one page."""
    name = f"urn:uuid:{uuid.uuid4()}"
    target = re.sub(r"[\x00-\x20]", lambda m: "%%%02X" % ord(m[0]), url) if url else None
    common = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page_id)]
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Transfer-Encoding: chunked\r\n\r\n")
    if revisit:
        first_url = re.sub(r"[\x00-\x20]", lambda m: "%%%02X" % ord(m[0]), first_url) if first_url else None
        yield _header("revisit", name, head, common + [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Target-URI", first_url),
            ("WARC-Refers-To-Date", DATE), ("X-Refers-To-Page-Id", first)])
        return
    block = head + chunked(html)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _header("response", name, block, common)
        return
    yield _header("response", name, parts[0], common + [("WARC-Segment-Number", 1)])
    for n, part in enumerate(parts[1:], 2):
        last = len(block) if n == len(parts) else None
        yield _header("continuation", f"urn:uuid:{uuid.uuid4()}", part, [
            ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", n),
            ("WARC-Segment-Total-Length", last)])


def _with_firsts(rows: DataFrame, least_revisit: int) -> DataFrame:
    """``rows(page_id, url, html, digest)`` with the page that each refers to.
    The repeated payloads are written before the join, so a hot digest can be split."""
    firsts = (rows.where(F.octet_length("html") >= least_revisit)
              .groupBy("digest").agg(F.count(F.lit(1)).alias("n"),
                                     F.max(F.struct("page_id", "url")).alias("first"))
              .where("n > 1").select("digest", "first"))
    return rows.join(staged(firsts, "firsts"), "digest", "left").select(
        "page_id", "url", "html", "digest", F.col("first.page_id").alias("first"),
        F.col("first.url").alias("first_url"),
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))).alias("revisit"))


def write_archives(pages: DataFrame, path: str, least_revisit: int = 1000,
                   segment_bytes: int = 16384) -> None:
    """Write ``pages(page_id, url, html, ...)`` as gzipped WARC files.

    A null html is an empty payload.  Of payloads of at least ``least_revisit``
    bytes that are equal, the row with the largest page_id is a response and
    the others are revisits of it (repeated rows of that id are all responses;
    null ids are below all others).  Null urls are left out of the header.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = batched(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("html"), F.sha1(body).alias("digest"))
    joined = _with_firsts(rows, least_revisit)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            for row in zip(*batch.columns):
                out.extend(records_of(*[x.as_py() for x in row], segment_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (joined.mapInArrow(write, "record binary").select(F.col("record").cast("string"))
     .write.option("maxRecordsPerFile", FILE_RECORDS).option("lineSep", RECORD_END).option("compression", "gzip").text(path))


class Damaged(Exception):
    """A part of a file that can't be inflated."""


def _inflate(raw: bytes, piece: int = 1 << 20) -> Iterator[bytes | Damaged]:
    """The content of a file, of any number of gzip members or none.  A member
    that is damaged or cut short gives what it held up to there and a ``Damaged``;
    the next member follows."""
    if raw[:2] != GZIP[:2]:
        yield raw
        return
    at, view = 0, memoryview(raw)
    while at < len(raw):
        member, begin = zlib.decompressobj(31), at
        try:
            while not member.eof and at < len(raw):
                part = member.decompress(view[at:at + piece])
                at += piece
                if part:
                    yield part
            at = min(at, len(raw)) - len(member.unused_data)
            if not member.eof:
                yield Damaged("cut short")
        except zlib.error as e:
            yield Damaged(str(e))
            at = raw.find(GZIP, begin + 1)
            if at < 0:
                return


def _fields(head: bytes) -> dict[str, str]:
    """Header fields, names in lower case."""
    lines = [line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]]
    return {key.strip().lower(): value.strip() for key, _, value in lines}


def parse(data: Iterator[bytes | Damaged]) -> Iterator[tuple[dict[str, str], bytes, str]]:
    """Header fields, block and status of each record of a stream.

    The status is ``ok``; ``cut`` for a record that ends before its length;
    ``header`` for one without a usable Content-Length, whose block goes up to the
    next record; or ``damaged``, without fields, where a part can't be read.
    """
    held, skip = bytearray(), 0
    ended, damaged = False, False

    def more() -> bool:
        nonlocal ended, damaged
        if not (ended or damaged):
            got = next(data, None)
            if got is None:
                ended = True
            elif isinstance(got, Damaged):
                damaged = True
            else:
                held.extend(got)
                return True
        return False

    def find(what: bytes, begin: int) -> int:
        """Place of ``what``, reading on as far as it takes; each byte is looked at once."""
        while (at := held.find(what, begin)) < 0:
            begin = max(begin, len(held) - len(what) + 1)
            if not more():
                return -1
        return at

    while True:
        if skip > BATCH_BYTES:  # not after each record, which would move the rest each time
            del held[:skip]
            skip = 0
        begin = find(b"WARC/", skip)
        end = find(b"\r\n\r\n", begin) if begin >= 0 else -1
        if end >= 0:
            fields = _fields(bytes(held[begin:end]))
            size = _number(fields.get("content-length"))
            if size is None or size < 0:
                after = find(b"\r\n\r\nWARC/", end)
                skip = after + 4 if after >= 0 else len(held)
                yield fields, bytes(held[end + 4:after if after >= 0 else len(held)]), "header"
            else:
                skip = end + 4 + size
                while len(held) < skip and more():
                    pass
                block = bytes(held[end + 4:skip])
                yield fields, block, "ok" if len(block) == size else "cut"
            skip = min(skip, len(held))
            continue
        if begin >= 0:
            yield _fields(bytes(held[begin:])), b"", "cut"
        if not damaged:
            return
        yield {}, b"", "damaged"
        held.clear()
        skip, damaged = 0, False


def _number(text: str | None) -> int | None:
    """A number of a header field that fits its column, or null."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, one row each (``RECORD``).

    ``status`` tells of broken archives (see ``parse``): a record that is cut
    short, or without a usable length, is a row with what there is of it, and a
    damaged or cut gzip member is a row of its own beside the records before it.
    An archive has to fit in a task's memory, compressed, and so has a record.
    """
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*[(n, kinds[k]) for n, k in (x.split() for x in RECORD.split(", "))])

    def row_of(archive: str, f: dict[str, str], block: bytes, status: str) -> tuple:
        segment = _number(f.get("warc-segment-number"))
        return (archive, f.get("warc-type"), f.get("warc-record-id", "").strip("<>") or None,
                f.get("warc-segment-origin-id", "").strip("<>") or None,
                segment if segment is None or abs(segment) < 1 << 31 else None,
                _number(f.get("warc-segment-total-length")), _number(f.get("x-page-id")), f.get("warc-target-uri"),
                f.get("warc-payload-digest", "").partition(":")[2] or None, _number(f.get("x-refers-to-page-id")),
                block, status)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, raw in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for fields, block, status in parse(_inflate(raw.as_py())):
                    rows.append(row_of(archive.as_py(), fields, block, status))
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return batched(spark.read.format("binaryFile").load(path)).select("path", "content").mapInArrow(read, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records from segmented ones.

    Segments are grouped by origin id and ordered by number.  ``status`` is
    ``ok``, ``gap`` (a number missing, null or repeated, or no origin), ``length`` (the
    total length differs) or that of a segment which could not be read whole.
    Unsegmented records pass straight through.  The segments of one record are
    joined in one task, which has to hold that record.
    """
    single = records.where("segment is null and origin_id is null")
    parts = records.where("segment is not null or origin_id is not null")
    names = ["segment", "total_length", "record_type", "archive", "page_id", "target", "digest", "refers_to", "status"]
    grouped = (parts.withColumn("origin", F.coalesce("origin_id", "record_id"))
               .groupBy("origin").agg(F.array_sort(F.collect_list(F.struct(*names, "block"))).alias("s")))
    first, last = F.element_at("s", 1), F.element_at("s", -1)
    numbers = F.transform("s", lambda x: x["segment"])
    bad = F.filter(F.transform("s", lambda x: x["status"]), lambda x: x != "ok")
    ordered = batched(grouped).select(
        first["archive"].alias("archive"), first["record_type"].alias("record_type"), F.col("origin").alias("record_id"),
        F.lit(None).cast("string").alias("origin_id"), F.lit(None).cast("int").alias("segment"),
        last["total_length"].alias("total_length"), first["page_id"].alias("page_id"), first["target"].alias("target"),
        first["digest"].alias("digest"), first["refers_to"].alias("refers_to"),
        F.transform("s", lambda x: x["block"]).alias("blocks"),
        F.coalesce(F.get(bad, F.lit(0)), F.when(
            ~F.coalesce(numbers == F.sequence(F.lit(1), F.size("s")), F.lit(False))
            | ~F.coalesce(first["record_type"] != "continuation", F.lit(False)), "gap"), F.lit("ok")).alias("status"))

    at, columns = ordered.columns.index("blocks"), records.columns

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a record may be large: a batch of its own
                row = batch.slice(i, 1)
                block = b"".join([x.as_buffer() for x in row.column(at)[0].values if x.is_valid])
                status = row.column("status")[0].as_py()
                if status == "ok" and row.column("total_length")[0].as_py() != len(block):
                    status = "length"
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:at], pa.array([block], pa.binary()), pa.array([status])], columns)

    return single.unionByName(ordered.mapInArrow(join, records.schema))


def payloads(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """Responses, revisits and all records with a fault, with ``payload`` (decoded;
    null where the record has none of its own or is broken), ``payload_bytes`` and
    ``payload_digest`` (of what was decoded) and ``status`` (also ``framing``: broken
    chunks).  ``with_payload=False`` leaves the payload itself out."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i, (kind, block, state) in enumerate(zip(
                    batch.column(0).to_pylist(), batch.column("block"), batch.column("status").to_pylist())):
                payload = None
                if kind == "response" and state == "ok":
                    head, _, body = block.as_py().partition(b"\r\n\r\n")
                    try:
                        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    except ValueError:
                        state = "framing"
                digest = None if payload is None else hashlib.sha1(payload).hexdigest()
                rows.append((state, payload if with_payload else None, None if payload is None else len(payload), digest))
                held += len(payload or b"") if with_payload else 0
                if held > BATCH_BYTES or i + 1 == batch.num_rows:
                    state, body, size, digest = (list(c) for c in zip(*rows))
                    columns = [*batch.slice(i + 1 - len(rows), len(rows)).columns[:5], pa.array(state, pa.string()),
                               pa.array(size, pa.int64()), pa.array(digest, pa.string())]
                    if with_payload:
                        columns.append(pa.array(body, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names)
                    rows, held = [], 0

    rows = batched(records).where("record_type in ('response', 'revisit') or status <> 'ok'").select(
        "record_type", "page_id", "target", "digest", "refers_to", "block", "status")
    schema = rows.drop("block").schema.add("payload_bytes", "long").add("payload_digest", "string")
    if with_payload:
        schema = schema.add("payload", "binary")
    names = schema.names
    return rows.mapInArrow(decode, schema)


def resolve_revisits(rows: DataFrame) -> DataFrame:
    """Gives revisits the size and digest of the payload that they refer to."""
    held = (rows.where("record_type = 'response' and status = 'ok'")
            .groupBy(F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("size")))
    revisits = (rows.where("record_type = 'revisit'").join(held, "digest", "left")
                .select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                        "record_type", "refers_to",
                        F.when(F.col("size").isNull(), "unresolved").otherwise(F.col("status")).alias("status")))
    return rows.where("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").unionByName(revisits)
