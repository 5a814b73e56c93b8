"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of anything but letters become one blank, and runs of one to three
characters are hashed into ``DIM`` bins. Document frequencies are counted over all training rows.
The weights are learned by follow-the-regularised-leader with elastic-net penalties on a sample
of at most ``SAMPLE`` distinct training rows, the same number for each language, drawn by a hash; a
fifth of it is kept out of the training and sets the temperature of the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import lean

DIM = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE = 3_000
EPOCHS = 3
# Learning rate, its smoothing, and the weights of the two penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.02
UNKNOWN = "und"
# Characters hashed at a time.
_PART = 1 << 20
_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text's n-grams and their counts; none when it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate(([False], letter[:-1]))
    chars = np.where(letter, codes, 32)[letter | before]
    counts = np.zeros(DIM, np.int64)
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for at in range(0, len(chars), _PART):
        part = chars[at : at + _PART + ORDERS[-1] - 1].astype(np.uint64)
        for n in ORDERS:
            size = min(_PART, len(part) - n + 1)
            if size <= 0:
                continue
            code = np.full(size, n, np.uint64) * _MIX[1]
            for k in range(n):
                code = (code ^ part[k : k + size]) * _MIX[0]
            counts += np.bincount(((code ^ (code >> np.uint64(29))) * _MIX[2] >> shift).astype(np.int64), minlength=DIM)
    bins = np.flatnonzero(counts)
    return bins, counts[bins]


def weighted(bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf[bins]
    return x / (np.linalg.norm(x) or 1.0)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(bins, counts, self.idf) @ self.weights[bins] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        bins, counts = grams(text)
        if not len(bins) or not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(bins, counts) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from ``(class, bins, values)``; each row updates the bins it has."""
    z, n = np.zeros((DIM, classes)), np.zeros((DIM, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def leader(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, bins, x = rows[i]
            w, b = leader(z[bins], n[bins], L1), leader(zb, nb, 0.0)
            off = _softmax(x @ w + b)
            off[y] -= 1.0
            g = x[:, None] * off
            z[bins] += g - (np.sqrt(n[bins] + g * g) - np.sqrt(n[bins])) / ALPHA * w
            n[bins] += g * g
            zb += off - (np.sqrt(nb + off * off) - np.sqrt(nb)) / ALPHA * b
            nb += off * off
    return leader(z, n, L1), leader(zb, nb, 0.0)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least negative log-likelihood, on a grid of its logarithm."""
    def loss(t: float) -> float:
        s = logits / t
        top = s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(y)), y]).mean())

    return min(np.exp(np.linspace(np.log(0.02), np.log(5.0), 120)), key=loss) if len(y) else 1.0


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from the rows with a language and a letter; without any, a model that knows none."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null and l is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                bins, _ = grams(t.as_py())
                df[bins] += 1
                n += len(bins) > 0
        bins = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, bins].astype(np.int32)), pa.array(np.r_[n, df[bins]])], names=["bin", "n"])

    # At most one row per bin comes to the driver.
    df = {r.bin: r.n for r in rows.select("t").mapInArrow(lean(frequencies), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    total = df.pop(-1, 0)
    idf = np.full(DIM, np.log(total + 1.0) + 1)
    for b, n in df.items():
        idf[b] = np.log((total + 1) / (n + 1)) + 1

    texts = rows.groupBy("l").agg(F.approx_count_distinct(F.xxhash64("t")).alias("n"))
    counts = {r.l: max(1, r.n) for r in texts.orderBy(F.desc("n"), "l").limit(sample).collect()}
    each = max(1, sample // max(1, len(counts)))
    draw = F.pmod(F.xxhash64("t", "l"), F.lit(1 << 30)) / float(1 << 30)
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, 1.2 * each / n)) for name, n in counts.items()], "l string, share double")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1)):
                bins, n = grams(t.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()]), pa.array([bins.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([n.astype(np.int32)], pa.list_(pa.int32()))], names=["l", "bins", "n"])

    some = rows.join(F.broadcast(shares), "l").filter(draw < F.col("share")).select("t", "l").distinct()
    drawn = some.limit(2 * sample).mapInArrow(lean(features), "l string, bins array<int>, n array<int>")
    names = sorted(counts)
    seen: dict[str, int] = {}
    data = []
    for r in sorted(drawn.collect(), key=lambda r: (r.l, len(r.bins), r.bins[:20])):
        if r.bins and seen.get(r.l, 0) < each:
            seen[r.l] = seen.get(r.l, 0) + 1
            bins = np.array(r.bins)
            data.append((names.index(r.l), bins, weighted(bins, np.array(r.n), idf)))
    if not data:
        return Model([], idf, np.zeros((DIM, 0)), np.zeros(0))
    kept = [d for i, d in enumerate(data) if i % 5 or len(data) < 50]
    held = [d for i, d in enumerate(data) if not i % 5]
    weights, bias = ftrl(kept, len(names))
    logits = np.array([x @ weights[b] + bias for _, b, x in held])
    t = temperature(logits, np.array([y for y, _, _ in held]))
    return Model(names, idf, weights.astype(np.float32), bias, t)


def identify(docs: DataFrame, model: Model, keep: list[str | Column], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with ``lang_pred`` and ``score``, the calibrated probability.

    ``und`` with score 0 for a text that is NULL or has no letter, and for all texts when the model
    knows no language. Repeated rows get equal results.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(lean(run), schema)
