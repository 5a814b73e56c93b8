"""Packing of token documents into sequences of a fixed window.

Documents are cut into whole windows and a rest. The lengths of all pieces make a histogram of
at most ``window`` bins, which is all the driver sees. Shallow combinations of lengths that fill a
window exactly are enumerated from it; non-negative least squares finds how often to use each,
so that together they use up the histogram. The counts are rounded down, raised greedily while
lengths last, and what remains is laid end to end and cut at the window, so no sequence but the
last is padded. A piece learns its place from its length and its rank within it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import lean, written
from regiscope.llm.tokens import encoder

WINDOW = 2048
# Most frequent lengths of which all pairs are completed to combinations of three.
COMMON = 48
SWEEPS = 60


def combinations(lengths: list[int], counts: dict[int, int], window: int, common: int = COMMON) -> list[tuple[int, ...]]:
    """Sets of up to four lengths of the histogram that fill the window exactly."""
    have = set(lengths)
    found = {(window,)} if window in have else set()
    for a in lengths:
        for repeats in (1, 2, 3):
            rest = window - a * repeats
            if rest in have:
                found.add(tuple(sorted((a,) * repeats + (rest,), reverse=True)))
    top = sorted(lengths, key=lambda n: (-counts[n], n))[:common]
    for i, a in enumerate(top):
        for b in top[i:]:
            if window - a - b in have:
                found.add(tuple(sorted((a, b, window - a - b), reverse=True)))
    return sorted(found)


def least_squares(combos: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Non-negative repeats whose use of lengths is nearest to the histogram, by coordinate descent."""
    left = {n: float(c) for n, c in counts.items()}
    uses = [tuple(Counter(c).items()) for c in combos]
    norms = [sum(k * k for _, k in u) for u in uses]
    x = [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for i, use in enumerate(uses):
            step = sum(k * left[n] for n, k in use) / norms[i]
            step = max(-x[i], step)
            if step:
                x[i] += step
                for n, k in use:
                    left[n] -= k * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


@dataclass
class Plan:
    """Where the pieces of each length go: ranks [low, high) of a length, in ascending order."""

    window: int
    keys: list[int] = field(default_factory=list)  # length << 40 | low
    rows: list[tuple[int, int, int, int]] = field(default_factory=list)  # low, first sequence, repeats, offset
    rest_base: int = 0


def plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Combinations with their repeats, then the residual stream; its rows have repeats 0 and, as
    their first sequence, the place in the stream where the length begins."""
    lengths = sorted(counts)
    combos = combinations(lengths, counts, window)
    wanted = least_squares(combos, counts)
    left, taken = dict(counts), dict.fromkeys(lengths, 0)
    entries: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def use(combo: tuple[int, ...], times: int) -> None:
        nonlocal sequence
        offset = 0
        for n, k in sorted(Counter(combo).items(), reverse=True):
            entries.append((n, taken[n], sequence, k, offset))
            taken[n] += k * times
            left[n] -= k * times
            offset += n * k
        sequence += times

    order = sorted(range(len(combos)), key=lambda i: (-wanted[i], combos[i]))
    for bound in (True, False):
        for i in order:
            fits = min(left[n] // k for n, k in Counter(combos[i]).items())
            times = min(fits, int(wanted[i])) if bound else fits
            if times:
                use(combos[i], times)
    out, stream = Plan(window, rest_base=sequence), 0
    for n in sorted(lengths, reverse=True):
        if left[n]:
            entries.append((n, taken[n], stream, 0, 0))
            stream += n * left[n]
    for n, low, first, k, offset in sorted(entries):
        out.keys.append(n << 40 | low)
        out.rows.append((low, first, k, offset))
    return out


def place(plan_: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank within it; a piece may run over its window."""
    at = np.searchsorted(np.array(plan_.keys, np.int64), length << 40 | rank, side="right") - 1
    low, first, repeats, offset = np.array(plan_.rows, np.int64).reshape(-1, 4)[at].T
    nth = rank - low
    each = np.maximum(repeats, 1)
    stream = first + nth * length
    rest = repeats == 0
    sequence = np.where(rest, plan_.rest_base + stream // plan_.window, first + nth // each)
    return sequence, np.where(rest, stream % plan_.window, offset + nth % each * length)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_row, key, _ids, _n)``: ids packed as bytes, the end id last, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            at = 0
            for ids, stops in enc.encode_many(batch.column(1)):
                raw, cuts = ids.tobytes(), [0, *(stops * enc.width).tolist()]
                out = [raw[a:b] + end for a, b in zip(cuts, cuts[1:])]
                n = pa.array([len(x) // enc.width for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(out)), pa.array(out, pa.binary()), n], names=[key, "_ids", "_n"])
                at += len(out)

    rows = docs.select(F.col(key), F.col(text))
    kind = rows.schema[key].dataType.simpleString()
    done = rows.mapInArrow(lean(run), f"`{key}` {kind}, _ids binary, _n long")
    return written(done.withColumn("_row", F.monotonically_increasing_id()), "token-ids", batch=1_000)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, key: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece: document, where it starts there, length, checksum of its ids, its sequence and offset.

    A NULL or empty text is its end id. Repeated rows are documents of their own; a NULL key is
    kept. An empty table gives no pieces. ``keep_ids`` adds the ids, packed as bytes.
    """
    tokens = encoded(docs, tokenizer, end_id, key, text)
    whole = F.expr(f"transform(sequence(0L, (_n - 1) div {window}), i -> "
                   f"struct(i * {window} as start, least({window}L, _n - i * {window}) as length))")
    pieces = tokens.select("_row", F.explode(whole).alias("p")).select("_row", "p.start", "p.length")
    # Position in a total order of (length, row, start); ties of a length are cut over partitions.
    position = F.monotonically_increasing_id()
    order = ["length", "_row", "start"]
    parts = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = written(parts.select(
        "*", F.shiftright(position, 33).alias("_part"), position.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")), "pieces")
    sizes = sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_base"))
    numbered = sorted_.join(F.broadcast(base), F.col("_part") == F.col("_p"))

    counts = {r.length: r["count"] for r in sorted_.groupBy("length").count().collect()}  # at most ``window`` rows
    made = plan(counts, window)
    below = np.cumsum([0] + [counts[n] for n in sorted(counts)])
    start_of = np.zeros(window + 1, np.int64)
    for n, b in zip(sorted(counts), below):
        start_of[n] = b

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, at = (batch.column(i).to_numpy() for i in range(4))
            sequence, offset = place(made, length, at - start_of[length])
            over = np.maximum(offset + length - window, 0)
            cut = over > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (
                (row, row[cut]), (start, (start + length - over)[cut]), (length - over, over[cut]),
                (sequence, sequence[cut] + 1), (offset, np.zeros(int(cut.sum()), np.int64)))],
                names=["_row", "start", "length", "sequence_id", "offset"])

    placed = numbered.select("_row", "start", "length", (F.col("_base") + F.col("_pos")).alias("at")).mapInArrow(
        lean(put), "_row long, start long, length long, sequence_id long, offset long")
    spots = placed.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("_spots"))
    joined = tokens.join(spots, "_row").select(key, "_ids", "_n", "_spots")
    kind = joined.schema[key].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        n = 8 if keep_ids else 7
        for batch in batches:
            out, of = [], []
            for i, (raw, total, spots) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3))):
                ids = raw.as_py()
                width = len(ids) // total
                for s in spots.as_py():
                    part = ids[s["start"] * width : (s["start"] + s["length"]) * width]
                    crc = zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes())
                    out.append((s["start"], s["length"], crc, total, s["sequence_id"], s["offset"], part))
                    of.append(i)
            cols = [batch.column(0).take(pa.array(of, pa.int64()))]
            cols += [pa.array([o[j] for o in out], kinds[j + 1]) for j in range(n - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=names[:n])

    return joined.mapInArrow(lean(check), f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long" + (", ids binary" if keep_ids else ""))
