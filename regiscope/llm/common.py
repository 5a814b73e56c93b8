"""Helpers of the operators: tables, written intermediate results, hash splits, array passes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiscope.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write once to the shared folder and read it back: cuts lineage without computing twice.

    ``batch`` bounds the rows of an Arrow batch while this table is made, for rows that are large.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(_BATCH)
    if batch:
        spark.conf.set(_BATCH, str(min(batch, int(before)) if int(before) > 0 else batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of Arrow batches; at a task's end its worker gives freed memory back.

    Workers outlive tasks and stages, and a freed batch otherwise stays with the allocators.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return wrapped


def _nullable(schema: StructType) -> StructType:
    return StructType([type(f)(f.name, f.dataType, True) for f in schema])


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % of


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by prefix and suffix minima of blocks."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Forest:
    """Union-find over 0..n-1; the smaller root wins."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join many pairs at once: hook the larger root to the smaller until none differ."""
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join many pairs at once; places of the pairs that joined two trees, a spanning forest of them."""
        at, used = np.arange(len(a)), [np.zeros(0, np.int64)]
        while len(at):
            ra, rb = self.roots(a[at]), self.roots(b[at])
            apart = ra != rb
            at, ra, rb = at[apart], ra[apart], rb[apart]
            high, first = np.unique(np.maximum(ra, rb), return_index=True)
            self.parent[high] = np.minimum(ra, rb)[first]
            used.append(at[first])
        return np.concatenate(used)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                break
            r = up
        self.parent[x] = r
        return r
