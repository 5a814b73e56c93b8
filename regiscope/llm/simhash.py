"""SimHash fingerprints and their Hamming join by walking binary tries.

A fingerprint bit is set when more than half of a text's shingle hashes have it. Fingerprints
of at most ``budget`` differing bits are linked. A 64-bit value cut into ``budget + 1`` blocks
agrees with each partner on a whole block, so the values are held in one trie per block, that
block's bits first: the subtrees below equal blocks are joined independently. In a subtree,
pairs of nodes are walked down together; a pair whose common prefixes differ in more bits than
the budget is dropped with everything below it. A subtree with too many values for one task is
cut further into pairs of child nodes (``_split``), with the bits spent so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import Forest, lean, mixed, written
from regiscope.llm.components import components

BITS = 64
# 64-bit words of a wide fingerprint.
WORDS = 4
SEED = 42
# Values of one subtree that a task walks at a time; larger subtrees are cut into node pairs.
SUBTREE = 20_000
# Bits by which a large subtree is cut.
STEP = 6
# Pairs of rows compared at a time.
PAIRS = 1 << 16
# Pairs of rows of two leaves up to which all are compared.
FEW = 4_096
# Node pairs held at a time.
FRONT = 200_000


def shingle_hashes(text: bytes | None, words: int, seed: int = SEED) -> np.ndarray:
    """Hashes of all runs of ``words`` words, repeats included; a shorter text is one run.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is what is meant.
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    line = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(line, seed)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], gaps[: len(tokens) - words] + 1)).tolist()
    ends = np.concatenate((gaps[words - 1 :], [len(line)])).tolist()
    return np.fromiter((digest(line[s:e], seed) for s, e in zip(starts, ends)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero when there are none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp)`` of every row: ``fp`` is the 64-bit value as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [majority(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=[key, "fp"])

    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"`{key}` {kind}, fp long")


def walk(values: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[np.ndarray]:
    """All pairs of equal values' ranges within the budget, as rows (low, high, low, high).

    ``values`` is sorted within each start node. ``pairs`` has a row (low, high, low, high) for
    each starting pair of nodes, a node being a range of values; equal ranges mean a node with
    itself. Every step goes down to the next bit at which one of two nodes branches; what lies
    above it is common to a node's values, so its differing bits are counted on the first.
    """
    stack = [pairs]
    while stack:
        front = stack.pop()
        if len(front) > FRONT:
            stack.append(front[FRONT:])
            front = front[:FRONT]
        l1, h1, l2, h2 = front.T
        first, second = _branch(values, l1, h1), _branch(values, l2, h2)
        top = np.maximum(first, second)
        above = _shift(values[l1] ^ values[l2], top + 1)
        keep = np.bitwise_count(above) <= budget
        keep &= ~((l1 == l2) & (top < 0) & (h1 - l1 == 1))
        l1, h1, l2, h2, first, second, top = (x[keep] for x in (l1, h1, l2, h2, first, second, top))
        leaf = top < 0
        if leaf.any():
            yield np.stack([x[leaf] for x in (l1, h1, l2, h2)], axis=1)
        l1, h1, l2, h2, first, second, top = (x[~leaf] for x in (l1, h1, l2, h2, first, second, top))
        if not len(l1):
            continue
        m1 = np.where(first == top, _cut(values, l1, h1, top), h1)
        m2 = np.where(second == top, _cut(values, l2, h2, top), h2)
        same = (l1 == l2) & (h1 == h2)
        halves = [(l1, m1, l2, m2), (l1, m1, m2, h2), (m1, h1, m2, h2), (m1, h1, l2, m2)]
        below = []
        for k, (a, b, c, d) in enumerate(halves):
            real = (a < b) & (c < d)
            if k == 3:
                real &= ~same  # the mirror image of the second
            below.append(np.stack([a[real], b[real], c[real], d[real]], axis=1))
        below = np.concatenate(below)
        if len(below):
            stack.append(below)


def _branch(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Highest bit at which the values of a node differ, -1 for a single value."""
    spread = values[low] ^ values[high - 1]
    bit = np.full(len(spread), -1, np.int64)
    some = spread > 0
    x, b = spread[some], np.zeros(int(some.sum()), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        up = (x >> np.uint64(step)) > 0
        b += up * step
        x = np.where(up, x >> np.uint64(step), x)
    bit[some] = b
    return bit


def _shift(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.where(by >= BITS, np.uint64(0), x >> np.minimum(by, BITS - 1).astype(np.uint64))


def _cut(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """First position in each sorted range that has the bit set."""
    low, high, bit = low.copy(), high.copy(), bit.astype(np.uint64)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        one = ((values[np.minimum(mid, len(values) - 1)] >> bit) & np.uint64(1)).astype(bool)
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)
    return low


def hamming_links(values: DataFrame, budget: int = 3, subtree: int = SUBTREE) -> DataFrame:
    """Links ``(a, b)`` that join all distinct values ``fp`` within the budget."""
    width = BITS // (budget + 1)
    tries = F.array(*(F.struct(F.lit(b).alias("rot"), _rotate(F.col("fp"), b * width).alias("turned"))
                      for b in range(budget + 1)))
    rows = values.select("fp").filter("fp is not null").distinct().select(
        F.col("fp").alias("id"), F.explode(tries).alias("t")).select("id", "t.*")
    return _trie_links(rows, width, BITS, budget, subtree)


def _rotate(x: Column, by: int, bits: int = BITS) -> Column:
    """The bits from ``by`` on first; a value of fewer bits stands in the highest."""
    if by == 0:
        return x
    turned = F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, bits - by))
    return turned if bits == BITS else turned.bitwiseAND(F.lit(-1 << (BITS - bits)))


@dataclass(frozen=True)
class Wide:
    """What a pair of wide fingerprints is tested for: at most ``total`` differing bits in ``names``, and sizes
    ``n`` of sets that can be as similar as ``similarity``. ``exact``: rows of one ``group`` are joined already, and
    a pair of two groups must be as similar by its sets."""

    names: list[str]
    total: int
    similarity: float
    exact: bool = False

    @property
    def columns(self) -> list[str]:
        return [*self.names, "n", *(["group"] if self.exact else [])]

    def test(self, rows: pd.DataFrame):
        bits, n = rows[self.names].to_numpy().view(np.uint64), rows["n"].to_numpy()

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            alike = np.minimum(n[a], n[b]) >= self.similarity * np.maximum(n[a], n[b]) - 1e-6
            return alike & (np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= self.total)

        return near

    def alike(self, x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both >= self.similarity * (len(x) + len(y) - both) - 1e-9


def _trie_links(rows: DataFrame, depth: int, bits: int, budget: int, subtree: int, wide: Wide | None = None,
                sets: DataFrame | None = None) -> DataFrame:
    """Links among rows ``(id, rot, turned, ...)``: one trie per ``rot``, the subtrees at ``depth``
    joined independently. With ``wide`` a pair must also pass its test of the further columns.
    Each task hands on a spanning forest of the links it finds, so that a crowded subtree
    gives a row per value and not one per pair: components are those of all links. The links of a
    ``wide`` forest are links found; with ``wide.exact`` they pass the test of their ``sets`` as well, which
    come to the rows after the last cut.
    """
    top = F.shiftrightunsigned("turned", BITS - depth).cast("string")
    rows = rows.withColumn("node", top).withColumn("side", F.lit(0)).withColumn("spent", F.lit(0))
    done = []
    while depth + STEP < bits:
        rows = written(rows, "subtrees")
        sizes = rows.groupBy("rot", "node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > subtree)
        large = written(sizes.select("rot", "node"), "large-subtrees")
        if large.isEmpty():
            break
        done.append(rows.join(large, ["rot", "node"], "left_anti"))
        rows = _split(rows.join(large, ["rot", "node"], "left_semi"), depth, budget)
        depth += STEP
    for more in done:
        rows = rows.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _forests(batches, budget, wide)

    columns = ["rot", "node", "side", "turned", "id", *(wide.columns if wide else [])]
    if sets is not None:
        columns.append("hashes")
        rows = rows.join(sets.select(F.col("id").alias("_id"), "hashes"), F.col("id") == F.col("_id"))
    placed = rows.select(*columns).repartition("rot", "node")
    return placed.sortWithinPartitions("rot", "node", "side").mapInArrow(lean(run), "a long, b long")


def _split(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """Cut nodes into pairs of their children ``STEP`` bits down, less those beyond the budget.

    ``node`` is the path of pairs so far; ``side`` says to which of its two nodes a value belongs
    (0: a node with itself); ``spent`` counts the bits in which the two differ so far.
    """
    # Differences of children by the bits left to spend.
    within = F.array(*(F.array(*(F.lit(m) for m in range(1 << STEP) if m.bit_count() <= left))
                       for left in range(budget + 1)))
    near = F.get(within, F.lit(budget) - F.col("spent"))
    x = F.shiftrightunsigned("turned", BITS - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1)).cast("int")
    out = rows.withColumn("x", x).withColumn("m", F.explode(near)).withColumn("y", F.col("x").bitwiseXOR(F.col("m")))
    # Of a node with itself, the smaller child is the first; of two nodes, side 1 is.
    ahead = F.when(F.col("side") == 0, F.col("x") <= F.col("y")).otherwise(F.col("side") == 1)
    path = F.concat_ws("/", "node", F.when(ahead, F.col("x")).otherwise(F.col("y")),
                       F.when(ahead, F.col("y")).otherwise(F.col("x")))
    side = F.when((F.col("side") == 0) & (F.col("m") == 0), F.lit(0)).otherwise(F.when(ahead, 1).otherwise(2))
    spent = F.col("spent") + F.bit_count("m")
    return out.withColumn("node", path).withColumn("side", side).withColumn("spent", spent).select(*rows.columns)


def _forests(batches: Iterator[pa.RecordBatch], budget: int, wide: Wide | None) -> Iterator[pa.RecordBatch]:
    """Walk the subtrees of a partition, some batches' worth at a time, each subtree whole."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch.to_pandas())
        size += batch.num_rows
        if size < SUBTREE:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = (rows["rot"] == rows["rot"].iloc[-1]) & (rows["node"] == rows["node"].iloc[-1])
        if not last.all():
            yield _forest(rows[~last], budget, wide)
        held = [rows[last]]
        size = len(held[0])
    if held:
        yield _forest(pd.concat(held, ignore_index=True), budget, wide)


def _forest(rows: pd.DataFrame, budget: int, wide: Wide | None) -> pa.RecordBatch:
    turned, ids = rows["turned"].to_numpy().view(np.uint64), rows["id"].to_numpy()
    group = pd.factorize(rows["rot"].astype(str) + ":" + rows["node"])[0]
    side = rows["side"].to_numpy()
    order = np.lexsort((turned, side, group))
    turned, ids, group, side = turned[order], ids[order], group[order], side[order]
    near = wide.test(rows.iloc[order]) if wide else None
    edge = np.flatnonzero(np.r_[True, (np.diff(group) != 0) | (np.diff(side) != 0)])
    end = np.r_[edge[1:], len(ids)]
    g, s = group[edge], side[edge]
    own = s == 0
    alone = np.stack([edge[own], end[own], edge[own], end[own]], axis=1)
    one, two = np.flatnonzero(s == 1), np.flatnonzero(s == 2)
    _, i, j = np.intersect1d(g[one], g[two], assume_unique=True, return_indices=True)
    one, two = one[i], two[j]
    crossed = np.stack([edge[one], end[one], edge[two], end[two]], axis=1)
    found = walk(turned, np.concatenate([alone, crossed]), budget)
    forest, kept = Forest(len(ids)), []
    if wide and wide.exact:
        _, first, member = np.unique(rows["group"].to_numpy()[order], return_index=True, return_inverse=True)
        forest.union(first[member], np.arange(len(ids)))
        raw = rows["hashes"].to_numpy()[order]

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        linked = near(a, b) if wide else np.ones(len(a), bool)
        if wide and wide.exact:
            linked = _confirmed_links(a, b, linked, forest, raw, wide)
            kept.append(np.stack([a[linked], b[linked]], axis=1))
            return linked
        a, b = a[linked], b[linked]
        if wide:
            used = forest.span(a, b)
            kept.append(np.stack([a[used], b[used]], axis=1))
        else:
            forest.union(a, b)
        return linked

    for leaves in found:
        few = (leaves[:, 1] - leaves[:, 0]) * (leaves[:, 3] - leaves[:, 2]) <= FEW
        for a, b in _crossed(leaves[few]):
            join(a, b)
        for l1, h1, l2, h2 in leaves[~few].tolist():
            rest = np.unique(np.concatenate([np.arange(l1, h1), np.arange(l2, h2)]))
            _grown(rest, join, forest.roots)
    if wide:
        used = np.concatenate([np.zeros((0, 2), np.int64), *kept])
        if not wide.exact:
            close = lambda a, b: near(a, b) & (np.bitwise_count(turned[a] ^ turned[b]) <= budget)
            used = _starred(used, forest, close, ids)
        return pa.RecordBatch.from_arrays([pa.array(ids[used[:, 0]]), pa.array(ids[used[:, 1]])], names=["a", "b"])
    at = np.arange(len(ids))
    root = forest.roots(at)
    linked = root != at
    return pa.RecordBatch.from_arrays([pa.array(ids[root[linked]]), pa.array(ids[linked])], names=["a", "b"])


def _starred(used: np.ndarray, forest: Forest, near, ids: np.ndarray) -> np.ndarray:
    """The same trees by links to the row with the smallest id of each, where they are links, and as many of the
    links found as join the rest: the forests of several tries then have most links in common."""
    rows = np.unique(used)
    order = rows[np.argsort(ids[rows], kind="stable")]
    _, first, member = np.unique(forest.roots(order), return_index=True, return_inverse=True)
    star = np.stack([order[first[member]], order], axis=1)
    star = star[star[:, 0] != star[:, 1]]
    links = np.concatenate([star[near(star[:, 0], star[:, 1])], used])
    return links[Forest(len(ids)).span(links[:, 0], links[:, 1])] if len(links) else links


def _thinned(pairs: DataFrame) -> DataFrame:
    """Fewer of the links ``(a, b)``, ``a`` below ``b``, with the same components: each ``b`` keeps its smallest
    ``a``, and two such neighbours of a row are held together by one row of those that have both."""
    lowest = pairs.groupBy(F.col("b").alias("_b")).agg(F.min("a").alias("low"))
    rest = pairs.join(lowest, F.col("b") == F.col("_b")).filter("a <> low").groupBy("low", "a").agg(F.min("b").alias("b"))
    return lowest.select(F.col("low").alias("a"), F.col("_b").alias("b")).unionByName(rest.select("a", "b")).distinct()


def _confirmed_links(a: np.ndarray, b: np.ndarray, near: np.ndarray, forest: Forest, raw: np.ndarray, wide: Wide) -> np.ndarray:
    """Which of the near pairs join two trees of the forest and are as similar by their sets; joins them."""
    out = np.zeros(len(a), bool)
    near = np.flatnonzero(near)
    near = near[forest.roots(a[near]) != forest.roots(b[near])]
    parent = forest.parent

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in near.tolist():
        x, y = root(a[i]), root(b[i])
        if x != y and wide.alike(np.frombuffer(raw[a[i]], np.uint64), np.frombuffer(raw[b[i]], np.uint64)):
            parent[max(x, y)] = min(x, y)
            out[i] = True
    return out


def _crossed(leaves: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the rows of pairs of leaves, those of a leaf with itself once, some at a time."""
    l1, h1, l2, h2 = leaves.T
    end = np.cumsum((h1 - l1) * (h2 - l2))
    for low in range(0, int(end[-1]) if len(end) else 0, PAIRS):
        at = np.arange(low, min(low + PAIRS, int(end[-1])))
        leaf = np.searchsorted(end, at, side="right")
        at -= np.r_[0, end][leaf]
        wide = (h2 - l2)[leaf]
        a, b = l1[leaf] + at // wide, l2[leaf] + at % wide
        once = (l1 != l2)[leaf] | (a < b)
        yield a[once], b[once]


def _grown(rest: np.ndarray, join, roots) -> None:
    """Join rows by all links between them, one component at a time: every row of it is compared with all
    rows still outside, until none is. Rows of a crowd are so compared with few others.
    """
    while len(rest) > 1 and (roots(rest) != roots(rest[:1])).any():
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            size = max(1, PAIRS // len(rest))
            tile, front = front[:size], front[size:]
            hit = join(np.repeat(tile, len(rest)), np.tile(rest, len(tile))).reshape(len(tile), -1).any(axis=0)
            front, rest = np.concatenate([front, rest[hit]]), rest[~hit]


def simhash_groups(docs: DataFrame, words: int = 3, budget: int = 3, text: str = "text",
                   key: str = "doc_id", subtree: int = SUBTREE) -> DataFrame:
    """``(key, fingerprint, component_id)`` of every row.

    ``component_id`` is the smallest key that can be reached over links. A NULL, empty or
    blank text has the fingerprint zero and is linked like any other. Repeated rows are rows of
    their own with the same values; a NULL key is grouped, but never a component's name unless
    all its keys are NULL. Only distinct fingerprints are joined, so copies cost nothing.
    """
    prints = written(fingerprints(docs, words, text, key), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min(key).alias("first"))
    links = components(hamming_links(prints, budget, subtree))
    named = classes.join(links, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group"))
    named = written(named, "classes")
    lowest = named.groupBy("group").agg(F.min("first").alias("component_id"))
    members = named.join(lowest, "group").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(members, F.col("fp") == F.col("_fp"), "left").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def wide_fingerprints(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, w0..w3, n, id)`` of every row: four 64-bit fingerprints from differently mixed hashes of the
    text's distinct shingles, their number and a hash of the set."""
    names = [f"w{k}" for k in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, WORDS + 2), np.uint64)
            for i, t in enumerate(batch.column(1)):
                hashes = np.unique(shingle_hashes(t.as_py(), words))
                for k in range(WORDS):
                    out[i, k] = majority(mixed(hashes + np.uint64(k)) if k else hashes)
                out[i, WORDS] = len(hashes)
                out[i, WORDS + 1] = _set_id(hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column.view(np.int64)) for column in out.T.copy())], names=[key, *names, "n", "id"])

    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in [*names, "n", "id"]))


def _set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def shingle_sets(docs: DataFrame, firsts: DataFrame, words: int, text: str, key: str) -> DataFrame:
    """``(id, hashes)``: the sorted distinct shingle hashes of the rows with one of the keys ``first``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            sets = [np.unique(shingle_hashes(t.as_py(), words)) for t in batch.column(0)]
            ids = np.array([_set_id(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "hashes"])

    rows = docs.join(firsts, F.col(key).eqNullSafe(F.col("_first")), "left_semi").select(F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(lean(run), "id long, hashes binary").dropDuplicates(["id"])


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have a Jaccard similarity of at least ``similarity``, by their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit[i] = both >= similarity * (len(x) + len(y) - both) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(hit)) for k in (0, 1)], names=["a", "b"])

    left = sets.select(F.col("id").alias("_a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("_b"), F.col("hashes").alias("y"))
    rows = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return rows.select("a", "b", "x", "y").mapInArrow(lean(run), "a long, b long")


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id",
                subtree: int = SUBTREE) -> DataFrame:
    """``(key, component_id)`` of every row, grouped by the similarity of their sets of word shingles.

    Shingle sets of Jaccard similarity s differ in an expected share acos(2s / (1 + s)) / pi of their
    bits. Texts are candidates when their 256 bits differ in no more than that share, plus two
    standard deviations of the estimate, so that pairs at the threshold are found. The bits are
    cut into eight slices of 32, each joined by tries with a budget of 3 bits; a pair at 0.8 comes
    within it in some slice with a probability of about 0.92, one at 0.85 of 0.98, equal texts always.
    Only candidates whose sets are as similar as that are linked (``_confirmed``).
    NULL, empty and blank texts are all equal; a NULL key is grouped but names no group.
    """
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    total = int(share * WORDS * BITS + 2 * np.sqrt(share * (1 - share) * WORDS * BITS))
    wide = Wide([f"w{k}" for k in range(WORDS)], total, similarity)
    prints = written(wide_fingerprints(docs, words, text, key), "wide-fingerprints", batch=1_000)
    classes = written(prints.groupBy("id", "n", *wide.names).agg(F.min(key).alias("first")), "classes")
    found = _confirmed(docs, classes, wide, words, text, key, subtree)
    named = classes.join(components(found), F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("_id"), "first", F.coalesce("component", "id").alias("group"))
    lowest = named.groupBy("group").agg(F.min("first").alias("component_id"))
    members = named.join(lowest, "group").select("_id", "component_id")
    return prints.join(members, F.col("id") == F.col("_id"), "left").select(key, "component_id")


def _confirmed(docs: DataFrame, classes: DataFrame, wide: Wide, words: int, text: str, key: str, subtree: int) -> DataFrame:
    """Links ``(a, b)`` with the components of all candidates whose sets are similar enough.

    First a spanning forest of the candidates is tested. Where a link of it fails, the tries are walked
    again with the sets at hand: all candidates between the groups so far are tested in the tasks, which hand
    on a spanning forest of the links that hold, so no pair that fails becomes a row.
    """
    def candidates(classes: DataFrame, wide: Wide, sets: DataFrame | None = None) -> DataFrame:
        half = F.lit(-1 << 32)
        tries = []
        for k in range(2 * WORDS):
            slice_ = (F.shiftleft(wide.names[k // 2], 32) if k % 2 else F.col(wide.names[k // 2]).bitwiseAND(half))
            tries += [F.struct(F.lit(4 * k + b).alias("rot"), _rotate(slice_, 8 * b, 32).alias("turned")) for b in range(4)]
        rows = classes.select("id", *wide.columns, F.explode(F.array(*tries)).alias("t")).select("id", *wide.columns, "t.*")
        out = written(_trie_links(rows, 8, 32, 3, subtree, wide, sets), "candidates", batch=1_000 if wide.exact else None)
        return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    pairs = written(_thinned(candidates(classes, wide).distinct()), "pairs")
    ends = pairs.select(F.col("a").alias("_end")).unionByName(pairs.select(F.col("b").alias("_end"))).distinct()
    touched = written(classes.join(ends, F.col("id") == F.col("_end"), "left_semi"), "touched")
    sets = written(shingle_sets(docs, touched.select(F.col("first").alias("_first")), words, text, key), "shingle-sets", batch=1_000)
    found = written(_similar(pairs, sets, wide.similarity), "similar", batch=500)
    if found.count() == pairs.count():
        return found
    crowds = components(pairs).withColumnRenamed("component", "crowd")
    groups = components(found).select(F.col("node").alias("_node"), "component")
    groups = written(crowds.join(groups, F.col("node") == F.col("_node"), "left").select(
        "node", "crowd", F.coalesce("component", "node").alias("group")), "groups")
    open_ = groups.groupBy("crowd").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low <> high")
    left = written(touched.join(groups.join(open_, "crowd", "left_semi").select("node", "group"),
                                F.col("id") == F.col("node")), "left")
    return written(found.unionByName(candidates(left, replace(wide, exact=True), sets).distinct()), "similar")
