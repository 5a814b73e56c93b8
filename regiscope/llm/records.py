"""Token ids in length-delimited binary files, with an offset index.

A record is framed as

    length of the payload   8 bytes, little-endian
    masked checksum of those 8 bytes   4 bytes
    payload   8 bytes document id, 1 byte id present, 1 byte width of an id, the ids
    masked checksum of the payload   4 bytes
    a line feed

The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a checksum over data
that hold checksums is no trivial value. Records stand in ascending order of document id, the
files in the order of their part numbers. The index is a table of its own with a row per record:
part, file, offset, bytes, document id, number of ids and ids before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiscope.llm.common import lean, written
from regiscope.llm.tokens import encoder
from regiscope.session import work_path

# Bytes of text that go into a file.
FILE_BYTES = 16 << 20
MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_LENGTH, _CHECK = struct.Struct("<Q"), struct.Struct("<I")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """A record less its line feed."""
    payload = struct.pack("<q?B", doc_id or 0, doc_id is not None, width) + ids
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def records(data: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """``(offset, bytes, doc_id, ids)`` of a file's records; a damaged frame raises."""
    at = 0
    while at < len(data):
        size, check = _HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != check or at + size + 17 > len(data):
            raise ValueError(f"damaged length at byte {at}")
        payload = data[at + 12 : at + 12 + size]
        if masked(payload) != _CHECK.unpack_from(data, at + 12 + size)[0]:
            raise ValueError(f"damaged record at byte {at}")
        doc_id, present, width = struct.unpack_from("<q?B", payload)
        yield at, size + 17, doc_id if present else None, np.frombuffer(payload, f"<u{width}", offset=10)
        at += size + 17


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id",
                  text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode whole texts and write their ids, ``end_id`` behind each, in ascending order of the key.

    A NULL or empty text is the end id alone; a NULL key comes first; equal keys are ordered by
    their text, then as they are read. Texts are dealt out by key range before they are encoded,
    so a task encodes, frames and writes about ``file_bytes`` of text.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = max(1, -(-size // file_bytes))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"),
                       F.monotonically_increasing_id().alias("r"))
    order = [F.asc_nulls_first("k"), F.xxhash64("t"), F.col("r")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = enc.width if end_id < 1 << 8 * enc.width else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for ids, stops in enc.encode_many(batch.column(1)):
                raw = ids.astype(f"<u{width}").tobytes()
                cuts = [0, *(stops * width).tolist()]
                out = [frame(k, raw[a:b] + end, width) for k, a, b in zip(keys[at:], cuts, cuts[1:])]
                at += len(out)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    framed = dealt.mapInArrow(lean(run), "record binary")
    framed.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Scan and verify all files; the index with a checksum of each record's ids.

    ``ids_crc32`` is the CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for i, file in enumerate(batch.column(0).to_pylist()):
                part = int(file.rsplit("/", 1)[-1].split("-")[1])
                before, out = 0, []
                for offset, size, doc_id, ids in records(batch.column(1)[i].as_py()):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    out.append((part, file, offset, size, doc_id, before, len(ids), crc))
                    before += len(ids)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        names=["part", "file", "offset", "bytes", "doc_id", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    found = written(files.mapInArrow(
        lean(run), "part int, file string, offset long, bytes long, doc_id long, before long, n_tokens long, ids_crc32 long"),
        "record-index")
    # One row per file, so a single window is bounded by the number of files.
    sums = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return found.join(F.broadcast(base), F.col("part") == F.col("p")).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        "part", "file", "offset", "bytes")


def read_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of the records that the index rows ``wanted`` name, file by file.

    The number of rows of a file bounds a group; shuffle the index first to read in random order.
    """
    spots = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "bytes")).alias("spots"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = files.join(spots, F.col("path") == F.col("file")).select("content", "spots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, spots in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                for s in spots.as_py():
                    for _, _, doc_id, ids in records(data[s["offset"] : s["offset"] + s["bytes"]]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                            names=["doc_id", "ids"])

    return rows.mapInArrow(lean(run), "doc_id long, ids array<int>")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files and read them back: the index."""
    spark = docs.sparkSession
    path = path or work_path(spark, "token-records")
    write_records(docs, path, tokenizer, end_id)
    return read_index(spark, path)
