"""WARC archives: write segmented records, read them back, reassemble and decode.

A payload travels as an HTTP response with chunked transfer framing. A block longer than a
segment is cut: the first segment keeps the record's own type, the others are continuation
records that name its identifier; the last one states the total length. Reading groups the
segments by origin identifier, orders them by number, checks that none is missing and that
their lengths add up, and takes the chunk framing off.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
REVISIT_FROM = 1000  # payload bytes
RECORDS_A_FILE = 4000
RECORD_END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"  # pages carry no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STATUS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[a : a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunk-framed body; a ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block


def _safe(url: str | None) -> str | None:
    """A url without line ends, which would end its header field."""
    return None if url is None else "".join("%%%02X" % ord(c) if c < " " else c for c in url)


def records_of(row: dict, segment: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    payload = row["payload"]
    urn = lambda n: f"<urn:page:{n}>"
    fields = [
        ("WARC-Type", row["kind"]),
        ("WARC-Record-ID", urn(row["record"])),
        ("WARC-Date", DATE),
        ("X-Page-ID", row["page_id"]),
        ("WARC-Target-URI", _safe(row["url"])),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["kind"] == "revisit":
        fields += [
            ("X-Refers-To-Page-ID", row["refers_to"]),
            ("X-Payload-Length", len(payload)),
            ("WARC-Profile", PROFILE),
        ]
        yield _record(fields, STATUS + b"\r\n")
        return
    block = STATUS + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield _record(fields, block)
        return
    starts = range(0, len(block), segment)
    for n, a in enumerate(starts, 1):
        own = fields if n == 1 else [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", urn(f"{row['record']}:{n}")),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", urn(row["record"])),
        ]
        last = [("WARC-Segment-Total-Length", len(block))] if a == starts[-1] else []
        yield _record([*own, ("WARC-Segment-Number", n), *last], block[a : a + segment])


def _written(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                out = [r for row in batch.slice(a, 256).to_pylist() for r in records_of(row, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def write_archive(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES) -> None:
    """Writes gzip WARC files below ``path``, one response or revisit record per page.

    Of pages with equal payloads of at least ``REVISIT_FROM`` bytes those with the largest
    page_id are responses, the others revisit it. A null html is an empty payload. A null
    page_id loses to any other; where all are null, all are responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    # Small payloads never share a record; their ids keep them from meeting in one task.
    large, own = F.length("payload") >= REVISIT_FROM, F.monotonically_increasing_id().cast("string")
    rows = rows.withColumn("large", large).withColumn("key", F.when(large, F.sha2("payload", 256)).otherwise(own))
    keys = rows.where("large").select("key", "page_id")
    chosen = keys.groupBy("key").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    # Few payloads repeat: the others need no partner, and their rows no shuffle by it.
    joined = rows.join(chosen.where("n > 1").select("key", "top"), "key", "left")
    response = F.col("top").isNull() | F.col("page_id").eqNullSafe(F.col("top"))
    named = joined.withColumn("record", F.concat_ws("-", "page_id", F.monotonically_increasing_id()))
    ready = named.select(
        "page_id",
        "url",
        "payload",
        F.when(response, "response").otherwise("revisit").alias("kind"),
        F.when(~response, F.col("top")).alias("refers_to"),
        "record",
    )
    records = ready.mapInArrow(_written(segment), "record binary")
    # A record is text to Spark's writer, which adds the record end and keeps the bytes.
    records.select(F.col("record").cast("string")).write.option("lineSep", RECORD_END).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def _stream(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Bytes of a file, which may be plain or consist of gzip members."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    at, rest = 0, b""
    while at < len(content) or rest:
        member = zlib.decompressobj(31)
        while not member.eof and (at < len(content) or rest):
            part = rest or content[at : at + step]
            at += 0 if rest else len(part)
            rest = b""
            yield member.decompress(part)
            rest = member.unused_data if member.eof else b""


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive file."""
    held, parts = bytearray(), _stream(content)

    def need(n: int) -> bool:
        while len(held) < n and (part := next(parts, None)) is not None:
            held.extend(part)
        return len(held) >= n

    while True:
        at = -1
        seen = 0
        while (at := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not need(seen + 1):
                if bytes(held).strip():
                    raise ValueError("a record is cut off in its header")
                return
        lines = bytes(held[:at]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, size = at + 4, int(fields["content-length"])
        if not need(start + size):
            raise ValueError("a record is cut off in its block")
        block = bytes(held[start : start + size])
        need(start + size + 4)
        del held[: start + size + 4]
        yield fields, block


PARTS = "origin string, part long, total long, kind string, page_id long, digest string, refers_to long, payload_length long, block binary"


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            (name, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
            for name, kind in (x.split() for x in PARTS.split(", "))
        ]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for fields, block in parse_records(content.as_py()):
                own = fields.get("warc-record-id")
                rows.append(
                    (
                        fields.get("warc-segment-origin-id", own),
                        _number(fields, "warc-segment-number") or 1,
                        # A record without segments is its own last one.
                        _number(fields, "warc-segment-total-length")
                        or (None if "warc-segment-number" in fields else len(block)),
                        fields.get("warc-type"),
                        _number(fields, "x-page-id"),
                        fields.get("warc-payload-digest"),
                        _number(fields, "x-refers-to-page-id"),
                        _number(fields, "x-payload-length"),
                        block,
                    )
                )
                size += len(block)
                if size > 4_000_000:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks put together, checked and decoded: a row keeps its identity if they are broken."""
    names = ["page_id", "kind", "refers_to", "payload_bytes", "payload_digest", "intact"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            blocks = [p["block"] for p in r["parts"]]
            whole = b"".join(blocks)
            numbered = [p["part"] for p in r["parts"]] == list(range(1, len(blocks) + 1))
            size = digest = None
            intact = numbered and r["total"] == len(whole)
            stated = base64.b32decode((r["digest"] or "sha1:").partition(":")[2]).hex()
            if r["kind"] == "revisit":
                size, digest = r["payload_length"], stated
            elif intact:
                head, _, body = whole.partition(b"\r\n\r\n")
                try:
                    framed = b"transfer-encoding: chunked" in head.lower()
                    payload = unchunked(body) if framed else body
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    intact = not stated or stated == digest
                except ValueError:
                    intact = False
            rows.append((r["page_id"], r["kind"], r["refers_to"], size, digest, intact))
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record that is not a continuation: page_id, kind, refers_to, payload_bytes,
    payload_digest (lower-case hex SHA-1), intact.

    Records in one segment are decoded where they are read; only segments are shuffled, by
    origin. ``intact`` is false, and size and digest are null, where a segment is missing,
    lengths do not add up, or the framing is broken; a segment without its origin has a
    null kind.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInArrow(_parsed, PARTS)
    piece = F.struct("part", "block")
    whole = parts.where("part = 1 and total is not null and kind <> 'continuation'")
    alone = whole.select(F.array(piece).alias("parts"), "total", "kind", "page_id", "digest", "refers_to", "payload_length")
    first = lambda name: F.max(F.when(F.col("kind") != "continuation", F.col(name))).alias(name)
    segmented = (
        parts.where("part > 1 or total is null or kind = 'continuation'")
        .groupBy("origin")
        .agg(
            F.sort_array(F.collect_list(piece)).alias("parts"),
            F.max("total").alias("total"),
            *(first(n) for n in ("kind", "page_id", "digest", "refers_to", "payload_length")),
        )
        .drop("origin")
    )
    schema = "page_id long, kind string, refers_to long, payload_bytes long, payload_digest string, intact boolean"
    return alone.unionByName(segmented).mapInArrow(_decoded, schema)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as an archive in the shared folder and reads it back: one row per
    page with page_id, payload_bytes, payload_digest, record_type, refers_to, intact."""
    spark = pages.sparkSession
    path = work_folder(spark, "warc")
    write_archive(pages, path)
    return read_archive(spark, path).withColumnRenamed("kind", "record_type")
