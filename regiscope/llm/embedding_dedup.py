"""Embedding near-duplicates: an exact metric range join of unit vectors.

Cosine 0.98 or more is a Euclidean distance of at most r = sqrt(2 - 2 * 0.98) between unit
vectors. Per label, pivots are vectors drawn by a hash; every vector lies in the cell of its
nearest pivot. A vector is also sent to another cell p, of a smaller number than its own, unless
the triangle inequality rules out that a partner lies there:

- d(v, p) > R(p) + r, where R(p) is the largest distance of a vector of the cell to its pivot;
- v (c - p) > r d(p, c), that is, v lies further than r from the plane between p and its own pivot c.

Products of unit vectors are exact to some units of rounding (``_rounding``), so squared distances
are, but distances near zero only to the root of that. Both tests leave room for it; between two
pivots of nearly one direction the second rules out nothing.

So each linked pair meets in exactly one cell, and cells are joined independently. A cell with
more than ``cell_rows`` rows is cut into blocks that meet pairwise, in tasks of their own. Every
candidate's cosine is computed from the vectors in double precision. Equal vectors are one class
from the start. A cell hands on counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from regiscope.llm.common import Forest, written
from regiscope.llm.components import components

THRESHOLD = 0.98
# Vectors a cell should hold; sets the number of pivots, up to MAX_PIVOTS over all labels.
CELL = 1_500
MAX_PIVOTS = 4_096
# Rows of a cell that one task joins; more are cut into blocks.
CELL_ROWS = 6_000
# Values of a block of cosines.
_TILE = 1_024
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def classes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(id, label, vec, size)``: distinct usable vectors by label, named by their smallest key."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = v.isNotNull() & F.col(label).isNotNull() & ~odd & F.exists(v, lambda x: x != 0)
    return vectors.filter(usable).groupBy(F.col(label).alias("label"), v.alias("vec")).agg(
        F.min(key).alias("id"), F.count(F.lit(1)).alias("size"))


def _pivots(rows: DataFrame, cell: int, most: int) -> dict:
    """Pivots by (label, dimension): vectors of the smallest hashes, at most ``most`` in all."""
    rows = rows.select("label", F.size("vec").alias("dim"), "id", "vec")
    found = rows.groupBy("label", "dim").count().filter(F.col("count") > cell).orderBy(F.desc("count")).limit(most).collect()
    counts = {(r["label"], r["dim"]): r["count"] for r in found}
    total = sum(-(-n // cell) for n in counts.values())
    share = min(1.0, most / total) if total else 1.0
    wanted = {k: max(1, int(-(-n // cell) * share)) for k, n in counts.items()}
    if not wanted:
        return {}
    # A hash sample of about three times the number wanted; the smallest hashes are taken from it.
    bounds = rows.sparkSession.createDataFrame(
        [(*k, min(1.0, 3 * n / counts[k])) for k, n in wanted.items()],
        StructType([rows.schema["label"], rows.schema["dim"], StructField("bound", DoubleType())]))
    draw = F.pmod(F.xxhash64("id", "label"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.withColumn("h", draw).join(F.broadcast(bounds), ["label", "dim"]).filter("h < bound")
    out = defaultdict(list)
    for r in sorted(drawn.collect(), key=lambda r: (r["h"], r["id"])):
        mine = out[(r["label"], r["dim"])]
        if len(mine) < wanted[(r["label"], r["dim"])]:
            mine.append(r["vec"])
    return {k: _unit(np.array(v, np.float64)) for k, v in out.items()}


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def _rounding(dim: int) -> float:
    """Bound of the error of a squared distance of unit vectors of ``dim`` components."""
    return 8 * (dim + 4) * float(np.finfo(np.float64).eps)


def _homes(rows: DataFrame, pivots) -> DataFrame:
    """Rows with the number of their cell and their distance to its pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for at, x, p in _by_label(batch, pivots.value):
                d = _distances(x, p)
                home[at] = d.argmin(axis=1)
                far[at] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home), pa.array(far)],
                                             names=[*batch.schema.names, "home", "far"])

    kind = rows.schema["vec"].dataType.simpleString()
    lab = rows.schema["label"].dataType.simpleString()
    rows = rows.select("id", "label", "vec", "size")
    return rows.mapInArrow(run, f"id long, label {lab}, vec {kind}, size long, home int, far double")


def _by_label(batch: pa.RecordBatch, pivots: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    groups = defaultdict(list)
    vec = batch.column(batch.schema.get_field_index("vec"))
    dims = vec.value_lengths().to_pylist()
    for i, lab in enumerate(batch.column(batch.schema.get_field_index("label")).to_pylist()):
        if (lab, dims[i]) in pivots:
            groups[(lab, dims[i])].append(i)
    for key, at in groups.items():
        yield np.array(at), _unit(_matrix(vec.take(pa.array(at)))), pivots[key]


def _replicas(homes: DataFrame, pivots, radii, r: float) -> DataFrame:
    """Each row in its own cell (``own``) and in the cells of smaller numbers it may have partners in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rows, cells, own = [np.arange(n)], [batch.column(4).to_numpy()], [np.ones(n, bool)]
            for at, x, p in _by_label(batch, pivots.value):
                home = cells[0][at]
                d = _distances(x, p)
                mine = d[np.arange(len(at)), home][:, None]
                reach = np.array([radii.value.get((batch.column(1)[int(at[0])].as_py(), p.shape[1], k), -1.0)
                                  for k in range(len(p))])
                off = _rounding(p.shape[1])
                between = np.sqrt(_distances(p, p)[home] ** 2 + off)  # at least the true distance
                near = d <= reach + r + _SLACK + 2 * math.sqrt(off)
                near &= (d * d - mine * mine) / 2 <= (r + _SLACK) * between + off
                near &= (reach >= 0) & (np.arange(len(p))[None, :] < home[:, None])
                i, k = np.nonzero(near)
                rows.append(at[i]), cells.append(k.astype(np.int32)), own.append(np.zeros(len(i), bool))
            take = np.concatenate(rows)
            cols = [batch.column(j).take(pa.array(take)) for j in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.concatenate(cells)), pa.array(np.concatenate(own))],
                names=["id", "label", "vec", "size", "cell", "own"])

    lab, kind = homes.schema["label"].dataType.simpleString(), homes.schema["vec"].dataType.simpleString()
    return homes.select("id", "label", "vec", "size", "home").mapInArrow(
        run, f"id long, label {lab}, vec {kind}, size long, cell int, own boolean")


def links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs at or above the threshold, tile by tile; ``same``: pairs within x only once."""
    ux, uy = _unit(x), _unit(y)
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))  # a length cannot overflow
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for a in range(0, len(x), _TILE):
        for b in range(a if same else 0, len(y), _TILE):
            i, j = np.nonzero(ux[a : a + _TILE] @ uy[b : b + _TILE].T >= threshold - 1e-7)
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            # Near the threshold the cosine is taken as written: dot / (norm * norm).
            for s in range(0, len(i), 1 << 16):
                p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                exact = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= threshold
                yield p[exact], q[exact]


def _join_cells(placed: DataFrame, threshold: float, cell_rows: int) -> DataFrame:
    """``(id, other, n)``: linked copies found in a cell, and the cell's spanning link of the row."""
    keys = ["label", "dim", "cell"]
    placed = placed.withColumn("dim", F.size("vec"))
    sizes = placed.groupBy(*keys).count().select(
        *(F.col(k).alias("_" + k) for k in keys), F.ceil(F.col("count") / cell_rows).cast("int").alias("blocks"))
    same = [F.col(k) == F.col("_" + k) for k in keys]
    rows = placed.join(sizes, same[0] & same[1] & same[2]).withColumn("block", F.pmod(F.xxhash64("id", "own"), F.col("blocks")).cast("int"))
    # Block b meets every block: one copy per other block, and one for itself.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("with", other).withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    rows = rows.select("id", "size", "vec", "own", (F.col("block") == F.col("low")).alias("first"),
                       (F.col("low") == F.col("high")).alias("alone"), *keys, "low", "high")

    def run(table: pa.Table) -> pa.Table:
        ids, size = table["id"].to_numpy(), table["size"].to_numpy()
        x = _matrix(table["vec"].combine_chunks())
        own, first = table["own"].to_numpy(), table["first"].to_numpy()
        forest, n = Forest(len(ids)), np.zeros(len(ids), np.int64)
        if table["alone"][0].as_py():
            home, guest = np.flatnonzero(own), np.flatnonzero(~own)
            jobs = [(home, home, True), (home, guest, False)]
        else:
            a, b, c, d = (np.flatnonzero(f & o) for f in (first, ~first) for o in (own, ~own))
            jobs = [(a, c, False), (a, d, False), (b, c, False)]
        for p, q, same in jobs:
            if len(p) and len(q):
                for i, j in links(x[p], x[q], threshold, same):
                    i, j = p[i], q[j]
                    np.add.at(n, i, size[j])
                    np.add.at(n, j, size[i])
                    forest.union(i, j)
        hit = np.flatnonzero(n)
        return pa.table({"id": ids[hit], "other": ids[forest.roots(hit)], "n": n[hit]})

    return rows.groupBy(*keys, "low", "high").applyInArrow(run, "id long, other long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", cell: int = CELL, most: int = MAX_PIVOTS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every row.

    Vectors that are NULL, zero, or hold NULL or non-finite components, and those with a NULL
    label, link with nothing and are their own component; so do vectors of different length.
    Repeated rows are vectors of their own that link with each other; keys are long.
    """
    r = math.sqrt(max(0.0, 2 - 2 * threshold))
    spark = vectors.sparkSession
    own = written(classes(vectors, key, vector, label), "vectors")
    pivots = spark.sparkContext.broadcast(_pivots(own, cell, most))
    homes = written(_homes(own, pivots), "homes")
    # One row per pivot: bounded by their number.
    far = homes.groupBy("label", F.size("vec").alias("dim"), "home").agg(F.max("far").alias("far")) if pivots.value else None
    wanted = {k for k in pivots.value}
    radii = {(x["label"], x["dim"], x["home"]): x["far"] for x in far.collect() if (x["label"], x["dim"]) in wanted} if far else {}
    placed = written(_replicas(homes, pivots, spark.sparkContext.broadcast(radii), r), "cells")
    found = written(_join_cells(placed, threshold, cell_rows), "links")
    groups = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy(F.col("id").alias("_i")).agg(F.sum("n").alias("_n"))
    named = own.join(counts, F.col("id") == F.col("_i"), "left").join(groups, F.col("id") == F.col("node"), "left").select(
        F.col("label").alias("_label"), F.col("vec").alias("_vec"),
        (F.coalesce("_n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    rows = vectors.select(F.col(key), F.col(vector).alias("_v"), F.col(label).alias("_l"))
    joined = rows.join(named, (F.col("_v") == F.col("_vec")) & (F.col("_l") == F.col("_label")), "left")
    component = F.coalesce("component_id", F.col(key))
    return joined.select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), (F.col(key) == component).alias("kept"))
