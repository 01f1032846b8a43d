"""WARC archives: records written in segments, read back and put together."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.tables import shared_folder, stored

SEGMENT_BYTES, CHUNK_BYTES, RECORDS_PER_FILE, MIN_BYTES = 16_384, 4_096, 20_000, 0
# Fixed values of the format.
VERSION, NEWLINE, RECORD_END = b"WARC/1.1", b"\r\n", "\r\n\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = b"2024-01-01T00:00:00Z"

PAGE = "page_id bigint, uri string, record_type string, refers_to bigint"
RECORD = f"{PAGE}, stated string, origin string, segment int, total bigint, block binary"
RESULT = f"{PAGE}, payload_bytes bigint, payload_digest string, digest_ok boolean, complete boolean, payload binary"
RECORD_TYPES = {
    "page_id": pa.int64(), "uri": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
    "stated": pa.string(), "origin": pa.string(), "segment": pa.int32(), "total": pa.int64(),
    "block": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "digest_ok": pa.bool_(), "complete": pa.bool_(), "payload": pa.binary(),
}


def _names(shape: str) -> list[str]:
    return [field.split()[0] for field in shape.split(", ")]


def _batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    names = _names(shape)
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, RECORD_TYPES[n]) for n, c in zip(names, columns)], names=names
    )


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """``payload`` in HTTP chunked framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x" % len(piece), NEWLINE, piece, NEWLINE]
    return b"".join([*parts, b"0", NEWLINE, NEWLINE])


def unchunked(body: bytes) -> bytes | None:
    """The payload of chunked framing; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(NEWLINE, at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or end + 2 + size > len(body):
            return None
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if body[at : at + 2] != NEWLINE:
            return None
        at += 2


def _record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """A record but for its end, which the text writer puts behind each row."""
    lines = [VERSION, *[b"%s: %s" % h for h in headers], b"Content-Length: %d" % len(block)]
    return NEWLINE.join([*lines, b"", b""]) + block


def page_records(page_id, uri, html, refers_to, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    payload = (html or "").encode()
    shared = [
        (b"WARC-Date", WARC_DATE),
        (b"WARC-Payload-Digest", b"sha1:" + sha1_base32(payload).encode()),
    ]
    if uri is not None:
        shared.append((b"WARC-Target-URI", " ".join(uri.split()).encode()))
    if page_id is not None:
        shared.append((b"X-Page-ID", b"%d" % page_id))
    own = f"<urn:uuid:{uuid.uuid4()}>".encode()
    kind = (b"Content-Type", b"application/http;msgtype=response")
    head = NEWLINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"])
    if refers_to is not None:
        yield _record(
            [
                (b"WARC-Type", b"revisit"),
                (b"WARC-Record-ID", own),
                (b"WARC-Profile", REVISIT_PROFILE),
                (b"X-Refers-To-Page", b"%d" % refers_to),
                *shared,
                kind,
            ],
            head + b"\r\nContent-Length: %d\r\n\r\n" % len(payload),
        )
        return
    block = head + b"\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, CHUNK_BYTES)
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    for number, piece in enumerate(pieces, 1):
        headers = [(b"WARC-Record-ID", own)] if number == 1 else [
            (b"WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>".encode()),
            (b"WARC-Segment-Origin-ID", own),
        ]
        if len(pieces) > 1:
            headers.append((b"WARC-Segment-Number", b"%d" % number))
        if number == len(pieces) > 1:
            headers.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        first = [(b"WARC-Type", b"response"), *shared, kind]
        yield _record([*headers, *(first if number == 1 else [(b"WARC-Type", b"continuation"), shared[0]])], piece)


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = MIN_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a record for each row of ``pages`` (``page_id, url, html``) to gzip files.

    Of pages with equal payloads of at least ``min_bytes`` bytes, the one with
    the smallest id is a response and the others are revisits that name it.
    A NULL html is an empty payload; a page without id never is what others
    refer to.  Payload framing is chunked, and blocks longer than
    ``segment_bytes`` go on in continuation records.
    """
    payload = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("mark"))
    firsts = stored(
        marked.where(F.octet_length("html") >= min_bytes)
        .groupBy("mark")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("mark", "first"),
        "warc-firsts",
    )
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = zip(*[c.to_pylist() for c in batch.slice(at, 500).columns])
                records = [r for row in rows for r in page_records(*row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["value"])

    (
        marked.join(firsts, "mark", "left")
        .select("page_id", "url", "html", refers_to.alias("refers_to"))
        .mapInArrow(build, "value binary")
        # The same bytes, typed as the text writer wants them.
        .select(F.col("value").cast("string"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def decoded(record_type: str, stated: str | None, block: bytes | None, with_payload: bool) -> tuple:
    """``payload_bytes, payload_digest, digest_ok, complete, payload`` of a whole block."""
    stated = (stated or "").rpartition(":")[2] or None
    if block is None:
        return None, stated, None, False, None
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(line.lower().split(b": ", 1) for line in head.split(NEWLINE)[1:] if b": " in line)
    if record_type == "revisit":
        length = fields.get(b"content-length")
        return int(length) if length else None, stated, None, length is not None, None
    payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
    if payload is None:
        return None, stated, None, False, None
    digest = sha1_base32(payload)
    return len(payload), digest, digest == stated if stated else None, True, payload if with_payload else None


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``, continuations put together.

    Columns: ``page_id, uri, record_type, refers_to, payload_bytes,
    payload_digest, digest_ok, complete, payload``.  Whole records are decoded
    where they are read.  Segments are grouped by the id of the record they
    begin with, ordered by number, and held against the stated total length;
    then the chunked framing is taken off.  ``complete`` is false, and the
    payload NULL, if a segment is missing or doubled, or if lengths or framing
    are wrong.  Continuations without a first record are left out, since no page
    is named.  A revisit has the length and digest it states, and no payload.

    A task holds one archive file as it is stored, unpacking record by record.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw)) if raw[:2].to_pybytes() != b"\x1f\x8b" else gzip.GzipFile(fileobj=pa.BufferReader(raw))
                rows, held = [], 0
                for h, block in parse_records(stream):
                    number = h.get("warc-segment-number")
                    page, refers = h.get("x-page-id"), h.get("x-refers-to-page")
                    row = (
                        int(page) if page else None, h.get("warc-target-uri"), h["warc-type"],
                        int(refers) if refers else None, h.get("warc-payload-digest"),
                        h.get("warc-segment-origin-id", h["warc-record-id"]) if number else None,
                        int(number) if number else None,
                        int(h.get("warc-segment-total-length", 0)) or None,
                    )
                    if number:
                        row += (block, None, None, None, None, None)
                    else:
                        row += (None, *decoded(row[2], row[4], block, with_payload))
                    rows.append(row)
                    held += len(block)
                    if held > 1 << 22:
                        yield _batch(rows, both)
                        rows, held = [], 0
                yield _batch(rows, both)

    both = RECORD + RESULT[len(PAGE) :]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    records = stored(files.select("content").mapInArrow(scan, both), "warc-records")
    whole = records.where("segment is null").select(*_names(RESULT))
    segmented = (
        records.where("segment is not null")
        .groupBy("origin")
        .agg(
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("total").alias("total"),
            *[F.max(F.when(F.col("segment") == 1, F.col(n))).alias(n) for n in (*_names(PAGE), "stated")],
        )
        .where("record_type is not null")
        .withColumn("joined", F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.block)"))
        .withColumn(
            "ok",
            (F.col("parts.segment") == F.sequence(F.lit(1), F.size("parts")))
            & (F.octet_length("joined") == F.col("total")),
        )
        .select(*_names(PAGE), "stated", F.when(F.col("ok"), F.col("joined")).alias("block"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                rows = zip(*[c.to_pylist() for c in batch.slice(at, 100).columns])
                yield _batch([(*r[:4], *decoded(r[2], r[4], r[5], with_payload)) for r in rows], RESULT)

    return whole.unionByName(segmented.mapInArrow(decode, RESULT))


def op2_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as archives and read back."""
    folder = shared_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok", "complete"
    )


# Base 32 by arithmetic on the digest's 160 bits, five at a time.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, strlen(html) AS payload_bytes,
             CAST(unhex(sha1(html)) AS BIT)::VARCHAR AS bits,
             min(page_id) OVER (PARTITION BY html) AS first
      FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST(1 + 16 * CAST(bits[i * 5 + 1] AS INTEGER) + 8 * CAST(bits[i * 5 + 2] AS INTEGER)
                  + 4 * CAST(bits[i * 5 + 3] AS INTEGER) + 2 * CAST(bits[i * 5 + 4] AS INTEGER)
                  + CAST(bits[i * 5 + 5] AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN NULL ELSE true END AS digest_ok,
       true AS complete
FROM d
"""
