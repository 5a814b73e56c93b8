"""Benchmark decontamination: windows of benchmark words searched in all documents.

The benchmark's windows are broadcast as a hash set over small word numbers, in blocks of at
about ``block_bytes`` of distinct benchmark items, so the broadcast has a fixed bound whatever the
benchmark's size; more blocks mean more passes over the documents. A worker makes the set of a
block once for all its tasks. A document is mapped to word numbers; only runs made of benchmark
words are hashed, and every hash hit is verified on the numbers themselves.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiscope.llm.common import lean, written

WINDOW = 10
# A worker needs up to about 40 bytes of memory for a byte.
BLOCK_BYTES = 2 << 20
# Lower-cases A-Z and blanks every other ASCII character that is not a digit or a letter.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Windows:
    """Windows of a block of items: word numbers, hashes by window length, and their items."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, frozenset | set]] = defaultdict(dict)
        for name, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            row, alone = np.array(ids, np.uint32), frozenset([name])
            for at in range(len(ids) - length + 1 if ids else 0):
                names = self.items[length].setdefault(row[at : at + length].tobytes(), alone)
                if isinstance(names, set):
                    names.add(name)
                elif name not in names:
                    self.items[length][row[at : at + length].tobytes()] = {*names, name}
        self.hashes = {
            n: np.unique(_folded(np.frombuffer(b"".join(w), np.uint32).reshape(-1, n).T)) for n, w in self.items.items()
        }

    def search(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words lie in an occurrence of a window, and the items found."""
        ids = np.fromiter(map(self.number.get, words, repeat(0)), np.uint32, len(words))
        hit, found = None, set()
        unknown = None
        for n, hashes in self.hashes.items():
            if len(ids) < n:
                continue
            if unknown is None:
                unknown = np.concatenate(([0], np.cumsum(ids == 0)))
            starts = np.flatnonzero(unknown[n:] == unknown[: len(unknown) - n])
            if not len(starts):
                continue
            codes = _rolling(ids, n)[starts]
            place = np.minimum(np.searchsorted(hashes, codes), len(hashes) - 1)
            for at in starts[hashes[place] == codes].tolist():
                names = self.items[n].get(ids[at : at + n].tobytes())
                if names is not None:
                    if hit is None:
                        hit = np.zeros(len(words), bool)
                    hit[at : at + n] = True
                    found |= names
        return hit, found


_HELD: dict[tuple[str, int], Windows] = {}


def _windows(held: Broadcast, block: str, window: int) -> Windows:
    """The worker's windows of a block; those of the block before are let go."""
    if (block, window) not in _HELD:
        _HELD.clear()
        _HELD[block, window] = Windows(held.value, window)
    return _HELD[block, window]


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of n numbers."""
    return _folded(ids[k : len(ids) - n + 1 + k] for k in range(n))


def _folded(places: Iterable[np.ndarray]) -> np.ndarray:
    """Polynomial hash over arrays of the numbers at each place."""
    return reduce(lambda code, ids: code * _BASE + ids, places, np.uint64(0))


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
           item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
           keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``_n_words``, ``_n_hit``, ``_hits`` (packed bits, one per word,
    NULL when nothing is hit) and ``_items`` (ids as strings, sorted).

    A NULL text has no words; an item without words has no window. Items with a NULL id mark
    words but are not listed. Repeated rows stay, each with the same result.
    """
    spark = docs.sparkSession
    wanted = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t")).distinct()
    size = wanted.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_n_hit": F.lit(0).cast("long"), "_hits": F.lit(None).cast("binary"),
                            "_items": F.array().cast("array<string>")})
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        held = spark.sparkContext.broadcast([(r.i, None if r.t is None else bytes(r.t)) for r in part.collect()])
        last = block + 1 == blocks
        out = _pass(out, held, window, text, keep_text or not last)
        if not last:
            out = written(out, "decontamination")
    return out


def _pass(docs: DataFrame, held: Broadcast, window: int, text: str, keep_text: bool) -> DataFrame:
    block = uuid.uuid4().hex
    kept = [f for f in docs.schema if keep_text or f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(held, block, window)
        for batch in batches:
            n_words, n_hit, hits, items = [], [], [], []
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            before = batch.column(batch.schema.get_field_index("_hits"))
            listed = batch.column(batch.schema.get_field_index("_items"))
            for t, h, i in zip(texts, before, listed):
                words = words_of(t.as_py())
                hit, found = windows.search(words)
                n_words.append(len(words))
                old = h.as_py()
                if hit is not None and old is not None:
                    hit |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(words)).astype(bool)
                packed = old if hit is None else np.packbits(hit).tobytes()
                hits.append(packed)
                n_hit.append(0 if packed is None else int(np.bitwise_count(np.frombuffer(packed, np.uint8)).sum()))
                names = i.as_py()
                items.append(sorted({*names, *(x for x in found if x is not None)}) if found else names)
            new = {"_n_words": pa.array(n_words, pa.int64()), "_n_hit": pa.array(n_hit, pa.int64()), "_hits": pa.array(hits, pa.binary()),
                   "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [new[f.name] if f.name in new else batch.column(batch.schema.get_field_index(f.name)) for f in kept],
                names=[f.name for f in kept])

    return docs.mapInArrow(lean(run), StructType(kept))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per document: words, words hit, items with occurring windows and a digest of their ids."""
    found = search(docs.select(key, options.get("text", "text")), benchmark, keep_text=False, **options)
    return found.select(
        key, F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items").cast("binary"), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without any window of the benchmark, columns as given."""
    return search(docs, benchmark, **options).filter(F.col("_hits").isNull()).select(*docs.columns)
