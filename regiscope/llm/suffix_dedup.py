"""Exact removal of byte strings of a given length that occur more than once in a corpus.

Every byte covered by a ``length``-byte string that also starts anywhere else, in the same
document or another, is removed; matches never cross documents and are judged on the input.

1. *Anchors.* Of every window of ``length`` bytes, the ``GRAM``-byte string with the smallest
   hash, the last of equals, is an anchor. Equal windows have equal anchors at the same place,
   so windows need comparing only below a shared anchor: one row for about 80 bytes of text.
2. *Hulls.* All windows around an anchor lie in a hull of ``2 * length - GRAM`` bytes. Anchors
   with one occurrence are dropped; occurrences with equal hulls are repeated whole and go on as
   one row. What is left are distinct hulls around equal anchors, the edges of copies.
3. *Suffix sort.* The hulls of an anchor are sorted from the anchor on, by mergesort; a
   comparison finds the common extension of two suffixes by binary search over prefix polynomial
   hashes. Going left a byte at a time, the order of the longer suffixes follows from that of
   the shorter by a stable sort on the byte put in front. Neighbours that agree on ``length``
   bytes are repeated windows; every agreement of hashes is verified on the bytes, and a
   collision makes the group be sorted on the bytes themselves.

Copies of a whole text are one text from the start. An anchor with more than ``group`` distinct
hulls is not brought together in a task; its hulls are told apart by longer strings first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import mixed, sliding_min, written

LENGTH = 200
GRAM = 40
# Distinct hulls of one anchor that are sorted in a task.
GROUP = 8_000
# Parts of the offsets for anchors with more.
PARTS = 8
# Hulls that a task sorts at a time (a group is never cut).
BATCH = 4_000
# Windows of a text that are hashed at a time; below 2**20.
SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(held)
    return held[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H[i] = sum of (byte + 1) * base**j over j < i, along the last axis, modulo 2**64."""
    out = np.zeros(data.shape[:-1] + (data.shape[-1] + 1,), np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(_BASE, data.shape[-1])
    np.cumsum(terms, axis=-1, out=out[..., 1:])
    return out


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's anchors, their hashes and the hashes of their hulls.

    Long texts are done a segment of windows at a time, with what their hulls need around it.
    """
    reach, n = length - gram, len(data)
    parts = [_anchors(data, at, min(at + SEGMENT, n - length + 1), reach, gram)
             for at in range(0, n - length + 1, SEGMENT)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    place, anchor, hull = (np.concatenate(p) for p in zip(*parts))
    place, once = np.unique(place, return_index=True)
    return place, anchor[once], hull[once]


def _anchors(data: np.ndarray, start: int, stop: int, reach: int, gram: int):
    """Anchors of the windows that begin in [start, stop)."""
    length = reach + gram
    base = max(0, start - reach)
    part = data[base : min(len(data), stop + 2 * length)]
    prefix, back = prefix_hashes(part), powers(_INVERSE, len(part) + 1)
    first, last = start - base, stop - 1 - base + reach
    grams = mixed((prefix[first + gram : last + 1 + gram] - prefix[first : last + 1]) * back[first : last + 1])
    # The low bits make the last of equal grams the smallest and tell its place.
    low = np.uint64((1 << 20) - 1)
    keyed = (grams | low) - np.arange(len(grams), dtype=np.uint64)
    place = first + np.unique((low - (sliding_min(keyed, reach + 1) & low)).astype(np.int64))
    begin, end = np.maximum(place - reach, 0 if base == 0 else place - reach), np.minimum(place + length, len(part))
    hull = (prefix[end] - prefix[begin]) * back[begin]
    edge = (place - begin).astype(np.uint64) * np.uint64(1 << 20) + (end - place).astype(np.uint64)
    return place + base, grams[place - first], mixed(hull ^ mixed(edge))


def suffix_order(data: np.ndarray, prefix: np.ndarray, start: int, group: np.ndarray) -> np.ndarray:
    """Order of the rows' suffixes from column ``start`` on, within groups, by mergesort.

    ``group`` numbers the rows' groups in ascending order. All pairs of runs of a round are merged at
    once: each row finds its rank in the other run by binary search.
    """
    n, width = data.shape
    order = np.arange(n)
    first = np.searchsorted(group, group, side="left")
    size = np.searchsorted(group, group, side="right") - first
    local = order - first
    run = 1
    while run < (size.max() if n else 0):
        mine = local // run
        other = first + (mine ^ 1) * run
        low, high = np.minimum(other, first + size), np.minimum(other + run, first + size)
        base, left = low.copy(), mine % 2 == 0
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            x, y = order[open_], order[mid[open_]]
            sign = _compare(data, prefix, start, y, x)
            # The left run's equals come first.
            ahead = np.where(left[open_], sign < 0, sign <= 0)
            at = np.flatnonzero(open_)
            low[at[ahead]] = mid[at[ahead]] + 1
            high[at[~ahead]] = mid[at[~ahead]]
        target = first + (mine - mine % 2) * run + (local - mine * run) + (low - base)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        run *= 2
    return order


def _compare(data: np.ndarray, prefix: np.ndarray, start: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sign of suffix x against suffix y: the byte behind their longest common extension.

    All suffixes start in the same column, so the hashes of equal stretches are equal as they
    stand and need no shift.
    """
    low, high = np.zeros(len(x), np.int64), np.full(len(x), data.shape[1] - start)
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = prefix[x, start + mid] - prefix[x, start] == prefix[y, start + mid] - prefix[y, start]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    at = np.minimum(start + low, data.shape[1] - 1)
    return np.sign(data[x, at].astype(np.int64) - data[y, at].astype(np.int64))


def repeated(data: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray,
             length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Per hull and offset r, whether the window that starts r bytes before the anchor is repeated.

    ``data`` holds a hull per row with its anchor in column ``length - gram``; ``left`` and
    ``right`` say how many bytes before and from the anchor are real.
    """
    reach = length - gram
    prefix = prefix_hashes(data)
    order = suffix_order(data, prefix, reach, group)
    out = np.zeros((len(data), reach + 1), bool)
    for r in range(reach + 1):
        if r:
            order = order[np.argsort(group[order] * 256 + data[order, reach - r], kind="stable")]
        rows = order[(left[order] >= r) & (right[order] >= length - r)]
        a, b = rows[:-1], rows[1:]
        window = slice(reach - r, reach - r + length)
        stretch = prefix[rows, reach - r + length] - prefix[rows, reach - r]
        same = (group[a] == group[b]) & (stretch[:-1] == stretch[1:])
        a, b = a[same], b[same]
        if len(a) and not (data[a, window] == data[b, window]).all():
            return _by_bytes(data, left, right, group, length, reach)
        out[a, r] = out[b, r] = True
    return out


def _by_bytes(data, left, right, group, length, reach) -> np.ndarray:
    """The same without hashes, used when two different strings have one hash."""
    out = np.zeros((len(data), reach + 1), bool)
    for r in range(reach + 1):
        seen: dict = {}
        for i in np.flatnonzero((left >= r) & (right >= length - r)).tolist():
            seen.setdefault((int(group[i]), data[i, reach - r : reach - r + length].tobytes()), []).append(i)
        for rows in seen.values():
            if len(rows) > 1:
                out[rows, r] = True
    return out


def covered(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
            group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Distinct texts ``(_t, _text, _copies)`` and the repeated ranges ``(_t, _ranges)`` of them."""
    rows = docs.select(F.xxhash64(F.col(text)).alias("_t"), F.col(text).cast("binary").alias("_text")).filter(
        F.col("_text").isNotNull())
    texts = rows.groupBy("_t").agg(F.first("_text").alias("_text"), F.count(F.lit(1)).alias("_copies"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for t, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t in seen:
                    continue
                seen.add(t)
                place, anchor, hull = anchors(np.frombuffer(x.as_py(), np.uint8), length, gram)
                if len(place):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(hull.view(np.int64)),
                         pa.array(np.full(len(place), t, np.int64)), pa.array(place.astype(np.int32))],
                        names=["anchor", "hull", "t", "at"])

    found = rows.filter(F.length("_text") >= length).mapInArrow(find, "anchor long, hull long, t long, at int")
    # Copies of a text count once.
    many = (F.min("t") != F.max("t")) | (F.min("at") != F.max("at"))
    twice = written(found.groupBy("anchor").agg(many.alias("many")).filter("many").select("anchor"), "anchor-keys")
    shared = written(found.join(twice, "anchor"), "anchors")
    hulls = shared.groupBy("anchor", "hull").agg(
        many.alias("whole"), F.min("t").alias("t"), F.min_by("at", "t").alias("at"))
    hulls = written(hulls, "hulls")
    open_ = hulls.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("settled"))
    open_ = hulls.join(open_.filter("n > 1 and not settled").select("anchor", "n"), "anchor")
    # A text with copies is removed whole, so its ranges need no listing, once for each copy.
    copied = rows.groupBy("_t").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("_t").alias("t"))
    whole = shared.join(hulls.filter("whole").select("anchor", "hull"), ["anchor", "hull"]).join(
        copied, "t", "left_anti").select("t", (F.col("at") - (length - gram)).alias("low"), (F.col("at") + length).alias("high"))

    wanted = open_.groupBy("t").agg(F.collect_list(F.struct("anchor", "at", "whole", "n")).alias("spots"))
    cut = _contexts(texts.join(wanted, F.col("_t") == F.col("t")).select("t", "_text", "spots"), length, gram)
    cut = written(cut, "contexts")
    edges = _sorted(cut.filter(F.col("n") <= group), length, gram)
    parts = whole.unionByName(edges).unionByName(_crowded(cut.filter(F.col("n") > group), length, gram, group))
    ranges = parts.groupBy("t").agg(F.collect_list(F.struct("low", "high")).alias("_ranges"))
    return texts, ranges.withColumnRenamed("t", "_t")


def _contexts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The hulls wanted of each text, padded to full width."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for t, x, spots in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw, out = x.as_py(), []
                for s in spots.as_py():
                    a = s["at"]
                    left, right = min(reach, a), min(length, len(raw) - a)
                    data = bytes(reach - left) + raw[a - left : a + right] + bytes(length - right)
                    out.append((s["anchor"], t, a, s["whole"], s["n"], left, right, data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["anchor", "t", "at", "whole", "n", "left", "right", "data"])

    return rows.mapInArrow(
        run, "anchor long, t long, at int, whole boolean, n long, left int, right int, data binary")


def _crowded(cut: DataFrame, length: int, gram: int, group: int) -> DataFrame:
    """Repeated ranges below anchors with very many hulls.

    The offsets of windows are cut into ``PARTS`` parts. All windows of a part share a core, the bytes
    that lie in each of them, so hulls are told apart by their cores first: most have one of
    their own and are done. Hulls with equal cores are sorted like others; where even those
    are too many, their windows are counted by hash, at most ``length / PARTS`` for a hull.
    """
    reach = length - gram
    step = -(-(reach + 1) // PARTS)
    parts = []
    for low in range(0, reach + 1, step):
        high = min(low + step - 1, reach)
        core = F.substring("data", reach - low + 1, low + length - high)
        real = F.greatest(F.lit(low), length - F.col("right")) <= F.least(F.lit(high), F.col("left"))
        parts.append(F.when(real, F.struct(F.lit(low).alias("low"), F.lit(high).alias("high"),
                                           F.xxhash64("anchor", F.lit(low), core).alias("core"))))
    keyed = cut.select("anchor", "t", "at", "whole", F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p"))
    keyed = written(keyed.select("anchor", "t", "at", "p.low", "p.high", "p.core"), "cores")
    counts = keyed.groupBy("core").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    alive = keyed.join(counts, "core").select(
        *(F.col(c).alias("_" + c) for c in ("anchor", "t", "at")), "core", "m", F.col("low").alias("first"), F.col("high").alias("last"))
    same = [F.col(c) == F.col("_" + c) for c in ("anchor", "t", "at")]
    hulls = cut.drop("n").join(alive, same[0] & same[1] & same[2])
    hulls = written(hulls.select(F.col("core").alias("anchor"), "t", "at", "whole", "left", "right", "data", "m", "first", "last"),
                    "core-hulls")
    few = _sorted(hulls.filter(F.col("m") <= group), length, gram)
    spots = F.sequence(F.greatest("first", length - F.col("right")), F.least("last", F.col("left")))
    rows = hulls.filter(F.col("m") > group).withColumn("r", F.explode(spots))
    window = F.col("data").substr(reach - F.col("r") + 1, F.lit(length))
    rows = rows.select("t", "at", "r", "whole", F.xxhash64("anchor", "r", window).alias("code"), F.hash(window).alias("check"))
    twice = rows.groupBy("r", "code", "check").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    windows = rows.filter("not whole").join(twice, ["r", "code", "check"])
    return few.unionByName(windows.select("t", (F.col("at") - F.col("r")).alias("low"), (F.col("at") - F.col("r") + length).alias("high")))


def _sorted(cut: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeated ranges of the hulls, whole groups of an anchor at a time."""
    reach = length - gram

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor = table["anchor"].to_numpy()
        data = np.frombuffer(b"".join(table["data"].to_pylist()), np.uint8).reshape(len(anchor), reach + length)
        group = np.cumsum(np.r_[0, anchor[1:] != anchor[:-1]])
        marks = repeated(data, table["left"].to_numpy(), table["right"].to_numpy(), group, length, gram)
        marks[table["whole"].to_numpy()] = False  # known already
        edge = np.diff(np.pad(marks.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        at = table["at"].to_numpy()[row]
        yield pa.RecordBatch.from_arrays(
            [pa.array(table["t"].to_numpy()[row]), pa.array((at - last).astype(np.int32)),
             pa.array((at - first + length).astype(np.int32))], names=["t", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = pa.Table.from_batches([batch.slice(at, BATCH)])
                held = part if held is None else pa.concat_tables([held, part])
                keys = held["anchor"].to_numpy()
                whole = int(np.searchsorted(keys, keys[-1], side="left"))
                if whole >= BATCH:
                    yield from solve(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None:
            yield from solve(held)

    rows = cut.select("anchor", "t", "at", "whole", "left", "right", "data")
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "t long, low int, high int")


def keep(raw: bytes, ranges, copies: int, length: int = LENGTH) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    if copies > 1 and len(raw) >= length:
        return b"", 1
    if not ranges:
        return raw, 0
    spans = np.array(sorted((max(0, r["low"]), min(len(raw), r["high"])) for r in ranges))
    high = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > high[:-1]]
    starts = spans[new, 0]
    ends = high[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]
    kept, at = [], 0
    for s, e in zip(starts.tolist(), ends.tolist()):
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept), len(starts)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, group: int = GROUP, keep_text: bool = False) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256)`` of every row, ``kept`` (binary) if wanted.

    NULL and empty texts have no bytes. Repeated rows are copies of each other, whatever their
    key; a text that occurs twice and has ``length`` bytes or more is removed whole.
    """
    texts, ranges = covered(docs, text, length, gram, group)
    joined = texts.join(ranges, "_t", "left").select("_t", "_text", "_copies", "_ranges")
    extra = ", kept binary" if keep_text else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, x, c, r in zip(batch.column(0).to_pylist(), batch.column(1),
                                  batch.column(2).to_pylist(), batch.column(3)):
                raw = x.as_py()
                kept, spans = keep(raw, r.as_py(), c, length)
                out.append((t, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["_t", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            n = 6 if keep_text else 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kinds[i]) for i in range(n)], names=names[:n])

    done = joined.mapInArrow(run, "_t long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + extra)
    empty = {"n_bytes": F.lit(0), "n_removed": F.lit(0), "n_spans": F.lit(0),
             "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    if keep_text:
        empty["kept"] = F.lit(b"")
    rows = docs.select(F.col(key), F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text))).alias("_id"))
    return rows.join(done, F.col("_id") == F.col("_t"), "left").select(
        key, *(F.coalesce(c, v.cast(done.schema[c].dataType)).alias(c) for c, v in empty.items()))
