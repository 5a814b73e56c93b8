"""WARC archives: written with revisits and segments, read back with reassembly.

A response is an HTTP message whose body is sent in chunks. A block longer than ``segment_bytes``
is cut into a first record and continuation records that name the first as their origin, numbered
from 1, the last with the total length. Reading groups segments by origin, orders them by
number, verifies numbers and total length, and decodes the chunked framing. Files are written
by Spark's text writer, whose line separator is the end of a WARC record, so they can lie
wherever Spark writes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.session import work_path

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
REVISIT_FROM = 1000
_END = "\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[at : at + size] for at in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Undo the chunked transfer framing, extensions and trailers included; bad framing raises."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";", 1)[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is not closed")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n%b\r\n%b" % (f"{lines}Content-Length: {len(block)}\r\n".encode(), block)


def record_id(row: int, number: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{row}/{number}')}>"


def records_of(row: int, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
               segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of a page, less the end of each. A row that revisits stores no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    common = [("WARC-Date", _DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        common.append(("WARC-Target-URI", "".join(url.split())))
    if page_id is not None:
        common.append(("X-Page-Id", str(page_id)))
    kind = [("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(row)), ("WARC-Profile", _PROFILE),
               ("X-Refers-To-Page-Id", str(refers_to))]
        yield _record(own + common + kind, _HTTP.split(b"Transfer")[0] + b"\r\n")
        return
    block = _HTTP + chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    for number, part in enumerate(parts, 1):
        own = [("WARC-Type", "response" if number == 1 else "continuation"), ("WARC-Record-ID", record_id(row, number))]
        if len(parts) > 1:
            own.append(("WARC-Segment-Number", str(number)))
        if number > 1:
            own.append(("WARC-Segment-Origin-ID", record_id(row)))
            if number == len(parts):
                own.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(own + (common + kind if number == 1 else [("WARC-Date", _DATE)]), part)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record; what is not a record raises."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:stop].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        begin, size = stop + 4, int(headers["content-length"])
        end = begin + size
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not closed")
        yield headers, data[begin:end]
        at = end + 4


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP response block."""
    head, body = block.split(b"\r\n\r\n", 1)
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def with_revisits(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html",
                  least: int = REVISIT_FROM) -> DataFrame:
    """``(row, page_id, url, payload, refers_to)``: of equal payloads of ``least`` bytes or more, that
    of the largest id is stored, the others refer to it. Rows that tie for the largest, and rows
    whose payloads all have NULL ids, are stored each. A NULL payload is empty.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page).cast("long").alias("page_id"),
                        F.col(url).alias("url"), payload.alias("payload"))
    digest = F.when(F.length("payload") >= least, F.concat(F.sha1("payload"), F.length("payload").cast("string")))
    rows = rows.withColumn("digest", digest)
    stored = rows.filter("digest is not null").groupBy(F.col("digest").alias("d")).agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    refers = F.when(F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    return rows.join(stored, F.col("digest") == F.col("d"), "left").select(
        "row", "page_id", "url", "payload", refers.alias("refers_to"))


def write_warc(rows: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the rows of ``with_revisits`` as gzipped archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = [batch.column(i).to_pylist() for i in (0, 1, 2, 4)]
            out = [r for row, page, url, refers, payload in zip(*small, batch.column(3))
                   for r in records_of(row, page, url, payload.as_py(), refers, segment_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    made = rows.select("row", "page_id", "url", "payload", "refers_to").mapInArrow(run, "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _END).option(
        "compression", "gzip").text(path)


_PAGE = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """A row per page of all archives: its ids, type, and the length and SHA-1 of its payload (with
    ``payload``, the bytes too); NULL for revisits, which store none. Only segmented records are
    shuffled, a record's segments to one task.
    """
    names = [x.strip().split(" ")[0] for x in _PAGE.split(",")] + ["payload"] * payload
    schema = _PAGE + ", payload binary" * payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def page(h: dict[str, str], block: bytes) -> tuple:
        revisit = h["warc-type"] == "revisit"
        data = None if revisit else payload_of(block)
        return (int(h["x-page-id"]) if "x-page-id" in h else None, h.get("warc-target-uri"), h["warc-type"],
                int(h["x-refers-to-page-id"]) if revisit else None, None if revisit else len(data),
                None if revisit else hashlib.sha1(data).hexdigest(), data)[: len(names)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                pages, parts = [], []
                for h, block in parsed(gzip.decompress(content.as_py())):
                    number = int(h.get("warc-segment-number", 0))
                    if not number:
                        pages.append(page(h, block))
                        continue
                    origin = h.get("warc-segment-origin-id", h["warc-record-id"])
                    head = "\r\n".join(f"{k}:{v}" for k, v in h.items())
                    parts.append((origin, number, int(h.get("warc-segment-total-length", 0)), head, block))
                cols = [pa.array([p[i] for p in pages] + [None] * len(parts), kinds[i]) for i in range(len(names))]
                more = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
                cols += [pa.array([None] * len(pages) + [p[i] for p in parts], more[i]) for i in range(5)]
                yield pa.RecordBatch.from_arrays(cols, names=names + ["origin", "number", "total", "head", "block"])

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(origin: str, parts: list) -> pa.RecordBatch:
            block = b"".join(p[3] for p in parts)
            if [p[0] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1][1] != len(block):
                raise ValueError(f"segments of {origin} are missing or differ from the total length")
            row = page(dict(x.split(":", 1) for x in parts[0][2].split("\r\n")), block)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        last, parts = None, []
        for batch in batches:
            for origin, *part in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if origin != last and parts:
                    yield finish(last, parts)
                    parts = []
                last = origin
                parts.append(part)
        if parts:
            yield finish(last, parts)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(scan, schema + ", origin string, number int, total long, head string, block binary")
    whole = found.filter("origin is null").select(*names)
    parts = found.filter("origin is not null").select("origin", "number", "total", "head", "block")
    return whole.unionByName(
        parts.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(reassemble, schema))


def archive(pages: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES,
            least: int = REVISIT_FROM) -> DataFrame:
    """Write archives of all pages and read them back; revisits get the length and digest of the
    response they refer to. A row per page row; repeated rows are pages of their own.
    """
    spark = pages.sparkSession
    path = path or work_path(spark, "warc")
    write_warc(with_revisits(pages, least=least), path, segment_bytes)
    found = read_warc(spark, path)
    # Rows that tie for the id of a response have equal payloads.
    stored = found.filter("record_type = 'response' and page_id is not null").groupBy(
        F.col("page_id").alias("_p")).agg(F.max(F.struct("payload_bytes", "payload_digest")).alias("_s"))
    seen = found.join(stored, F.col("refers_to") == F.col("_p"), "left")
    return seen.select(
        "page_id", F.coalesce("payload_bytes", "_s.payload_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_s.payload_digest").alias("payload_digest"), "record_type", "refers_to", "url")
