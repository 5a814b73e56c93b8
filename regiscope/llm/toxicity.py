"""Toxicity: a factorization machine over hashed terms.

Terms are a text's words and their first four and five letters, hashed to ``BINS``. From a sample of
labelled rows, at most ``SAMPLE`` of each class drawn by a hash, the ``TERMS`` bins that differ most
between the classes (chi-square) are kept. The machine adds to the weights of the terms present
a weight for each pair of them, the product of two learned vectors, so that words that are harmless
apart can count together. The bias is shifted from the sample's share of toxic rows to the
share among all labelled training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import written

BINS = 1 << 22
SAMPLE = 2_500
TERMS = 4_096
LEAST = 4
FACTORS = 8
EPOCHS = 12
RATE, DECAY = 0.1, 1e-4
# Words whose terms a worker remembers.
REMEMBERED = 400_000
_WORD = re.compile(r"[^\W_]+")


def terms(word: str) -> tuple[int, ...]:
    """Bins of a word: itself and, of longer ones, its beginnings."""
    parts = ["w" + word]
    parts += [f"{n}{word[:n]}" for n in (4, 5) if len(word) > n]
    return tuple(xxhash.xxh64_intdigest(p) % BINS for p in parts)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


class _Known(dict):
    """Terms of a word that a model knows."""

    def __init__(self, place: dict[int, int]) -> None:
        super().__init__()
        self.place = place

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.place[b] for b in terms(word) if b in self.place)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


@dataclass
class Model:
    bins: list[int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    _known: _Known | None = field(default=None, repr=False)

    def present(self, text: str | None) -> np.ndarray:
        """Numbers of the known terms of a text, each once."""
        if self._known is None:
            self._known = _Known({b: i for i, b in enumerate(self.bins)})
        found: set[int] = set()
        for t in filter(None, map(self._known.__getitem__, words(text))):
            found.update(t)
        return np.fromiter(found, np.int64, len(found))

    def score(self, text: str | None) -> float:
        at = np.sort(self.present(text))
        return float(1 / (1 + np.exp(-np.clip(margin(at, self.bias, self.weights, self.factors)[0], -35, 35))))


def margin(at: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias, weights and pair weights of the terms present; the sum of their vectors besides."""
    v = factors[at]
    total = v.sum(axis=0)
    return bias + weights[at].sum() + 0.5 * float(total @ total - (v * v).sum()), total


def train(rows: list[tuple[int, np.ndarray]], size: int, factors: int = FACTORS, epochs: int = EPOCHS) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by stochastic gradients with a rate per weight, and a decay."""
    rng = np.random.default_rng(0)
    bias, w, v = 0.0, np.zeros(size), rng.normal(0, 0.01, (size, factors))
    gb, gw, gv = 1.0, np.ones(size), np.ones((size, factors))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, at = rows[i]
            m, total = margin(at, bias, w, v)
            off = 1 / (1 + np.exp(-np.clip(m, -35, 35))) - y
            gb += off * off
            bias -= RATE * off / np.sqrt(gb)
            if len(at):
                g = off + DECAY * w[at]
                gw[at] += g * g
                w[at] -= RATE * g / np.sqrt(gw[at])
                h = off * (total - v[at]) / max(1.0, len(at) ** 0.5) + DECAY * v[at]
                gv[at] += h * h
                v[at] -= RATE * h / np.sqrt(gv[at])
    return bias, w, v


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from labelled rows; a document with several labels is toxic if one says so, NULL labels
    say nothing. Without rows of both classes, a model that gives the share of toxic rows.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.max(F.col(label)).cast("int").alias("y")).filter("y in (0, 1)")
    shares = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("_k"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for y, n in shares.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = known.filter(draw < share).limit(3 * sample)
    rows = docs.select(F.col(key), F.col(text).alias("_text")).join(
        F.broadcast(drawn), F.col(key) == F.col("_k")).limit(3 * sample).select("y", "_text")

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sorted({b for w in words(t.as_py()) for b in terms(w)}) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["y", "bins"])

    found = written(rows.mapInArrow(binned, "y int, bins array<int>"), "toxic-terms")
    size = {r.y: r["count"] for r in found.groupBy("y").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        rate = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
        return Model([], float(np.log(rate / (1 - rate))), np.zeros(0), np.zeros((0, FACTORS)))
    a, b = F.sum("y"), F.sum(1 - F.col("y"))
    chi = (a * neg - b * pos) * (a * neg - b * pos).cast("double") / ((a + b) * (pos + neg - a - b + 1))
    best = found.select("y", F.explode("bins").alias("bin")).groupBy("bin").agg(chi.alias("chi"), F.count(F.lit(1)).alias("n"))
    kept = [r.bin for r in best.filter(F.col("n") >= LEAST).orderBy(F.desc("chi"), "bin").limit(TERMS).collect()]
    place = {x: i for i, x in enumerate(kept)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[place[x] for x in r if x in place] for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["y", "at"])

    data = [(r.y, np.array(r.at, np.int64)) for r in found.mapInArrow(cut, "y int, at array<int>").collect()]
    data.sort(key=lambda r: (r[0], r[1].tolist()))
    bias, w, v = train(data, len(kept))
    bias += float(np.log(shares.get(1, 0) / shares.get(0, 1)) - np.log(pos / neg))
    return Model(kept, bias, w, v)


def score(docs: DataFrame, model: Model, keep: list[str | Column], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with ``score`` (0 to 1) and ``predicted``.

    A NULL, empty or wordless text has the score of the bias alone.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([held.value.score(t.as_py()) for t in batch.column(batch.num_columns - 1)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"])

    schema = rows.drop("_text").schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)
