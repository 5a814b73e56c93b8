"""The trie of conversations by their first turns, from vertical bitmaps.

Rows are dealt to tasks by ranges of conversation ids. A task cuts its range into shards of some
thousand conversations and indexes each shard vertically: for every (position, turn) a bitset of the
conversations that have this turn there, and for every length a bitset of those that end there. The
shard's trie is walked depth first: a node's members intersected with the bitset of a turn at the
next position are a child, their popcount its conversations, and what ends there its end list.

Nodes of different shards are the same when the digests of their paths are. Counts add up, the
smallest id is a minimum, and end lists follow one another, since shards are ranges of ids; so a
first turn that a third of all conversations share is one row per shard and not one per conversation.

Sums over subtrees need no recursion. The nodes that have conversation c as their smallest member are
the tail of its path, from some depth on; each node belongs to one such tail. A sum over the distinct
nodes below a node is therefore one over its members, of what lies in their tails.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import lean, written

# Conversations of a shard, and turns beyond which a shard takes no further conversation.
SHARD = 4_096
SHARD_TURNS = 65_536
ROOT = b""
_PARTS = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()), ("low", pa.int64()),
                    ("ends", pa.string()), ("convs", pa.list_(pa.int64())), ("rest", pa.list_(pa.int64()))])


def _members(bits: int) -> list[int]:
    """Places of the set bits, ascending."""
    if bits.bit_count() > 16:
        raw = np.frombuffer(bits.to_bytes(-(-bits.bit_length() // 8), "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()
    found = []
    while bits:
        low = bits & -bits
        found.append(low.bit_length() - 1)
        bits ^= low
    return found


class Shard:
    """Vertical bitmaps of some conversations, ``paths`` being the turns of each, by ascending ``ids``."""

    def __init__(self, ids: list[int], paths: list[list[bytes]], sizes: list[list[int]]) -> None:
        self.ids, self.paths = ids, paths
        # Bytes of a conversation's turns from each depth on; the root has none of its own.
        self.rest = []
        for own in sizes:
            left = np.cumsum(np.array(own[::-1], np.int64))[::-1].tolist()
            self.rest.append([left[0] if left else 0, *left])
        self.postings: list[dict[bytes, int]] = []
        self.ending: defaultdict[int, int] = defaultdict(int)
        for place, path in enumerate(paths):
            bit = 1 << place
            self.ending[len(path)] |= bit
            for position, turn in enumerate(path):
                if position == len(self.postings):
                    self.postings.append(defaultdict(int))
                self.postings[position][turn] |= bit

    def nodes(self) -> Iterator[tuple]:
        """Rows of ``_PARTS``: each node of the shard's trie, parents before children."""
        stack = [((1 << len(self.ids)) - 1, ROOT, None, 0)]
        while stack:
            members, key, parent, depth = stack.pop()
            who = _members(members)
            ended = members & self.ending.get(depth, 0)
            names = ",".join(str(self.ids[i]) for i in _members(ended)) if ended else None
            yield (key, parent, depth, members.bit_count(), self.ids[who[0]], names,
                   [self.ids[i] for i in who], [self.rest[i][depth] for i in who])
            left = members ^ ended
            while left:
                turn = self.paths[(left & -left).bit_length() - 1][depth]
                child = left & self.postings[depth][turn]
                left ^= child
                stack.append((child, hashlib.blake2b(key + turn, digest_size=16).digest(), key, depth + 1))


def _rebuilt(conv: np.ndarray, turns: list[bytes], sizes: list[int], heads: np.ndarray, group: int) -> Shard:
    """A shard from rows by (conversation, order); each takes over as many turns of its group's first
    conversation as ``heads`` says, in place of its own."""
    start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    stop = np.r_[start[1:], len(conv)].tolist()
    ids, take = conv[start].tolist(), heads[start].tolist()
    start = start.tolist()
    at = {c: i for i, c in enumerate(ids)}
    paths, lengths = [], []
    for i, c in enumerate(ids):
        base = at.get(c - int(np.fmod(c, group))) if take[i] else None
        low, high = (start[base], min(start[base] + take[i], stop[base])) if base is not None else (0, 0)
        own = min(start[i] + take[i], stop[i])
        paths.append(turns[low:high] + turns[own : stop[i]])
        lengths.append(sizes[low:high] + sizes[own : stop[i]])
    return Shard(ids, paths, lengths)


def _parts(batches: Iterator[pa.RecordBatch], group: int, most: int) -> Iterator[pa.RecordBatch]:
    """Shards of a task's rows, which come by conversation, each group of conversations in one."""
    def built(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        conv, heads = rows.column("conv").to_numpy(), rows.column("heads").to_numpy()
        shard = _rebuilt(conv, rows.column("turn").to_pylist(), rows.column("size").to_pylist(), heads, group)
        held: list[tuple] = []
        for row in shard.nodes():
            held.append(row)
            if len(held) == 4_096:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    held: list[pa.RecordBatch] = []
    size, enough = 0, SHARD_TURNS
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < enough:
            continue
        rows = pa.Table.from_batches(held)
        cuts = _cuts(rows.column("conv").to_numpy(), group, most)
        for low, high in zip(cuts[:-2], cuts[1:-1]):
            yield from built(rows.slice(low, high - low).combine_chunks())
        # The last shard may go on in the next batch.
        held = rows.slice(cuts[-2]).combine_chunks().to_batches()
        size = sum(b.num_rows for b in held)
        enough = max(SHARD_TURNS, 2 * size)
    if size:
        rows = pa.Table.from_batches(held)
        cuts = _cuts(rows.column("conv").to_numpy(), group, most)
        for low, high in zip(cuts, cuts[1:]):
            yield from built(rows.slice(low, high - low).combine_chunks())


def _cuts(conv: np.ndarray, group: int, most: int) -> list[int]:
    """Where shards begin and end: at the first group beyond ``most`` conversations or the limit of turns."""
    if not len(conv):
        return [0]
    families = (conv - np.fmod(conv, group)) // group
    edges = np.flatnonzero(np.r_[True, families[1:] != families[:-1]])
    seen = np.cumsum(np.r_[True, conv[1:] != conv[:-1]])[edges] - 1
    cuts, last = [0], 0
    for edge, convs in zip(edges.tolist(), seen.tolist()):
        if edge and (convs - last >= most or edge - cuts[-1] >= SHARD_TURNS):
            cuts.append(edge)
            last = convs
    return [*cuts, len(conv)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _PARTS)], schema=_PARTS)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end list, whose parts come in order; nothing but the hash's state is held."""
    key, state = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for node, names in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if node == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(names.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, kind in enumerate((pa.binary(), pa.string()))],
                                             names=["key", "ends_sha256"])
            done = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])


def prefix_trie(turns: DataFrame, heads: int = 0, group: int = 5, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", shard: int = SHARD) -> DataFrame:
    """A row per node, a node being a distinct sequence of the first ``depth`` turns of some conversation.

    ``conv_id`` its smallest member, ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``
    members, ``n_children``, ``n_leaves`` childless nodes in its subtree, ``saved_tokens`` the sum over
    its subtree of (members - 1) times the bytes of the last text, ``ends_sha256`` of the ids that end there,
    ascending, comma-joined.

    With ``heads``, conversation c takes over the first crc32(c) % heads turns of conversation
    c - c % group (all if fewer, none if absent) in place of as many of its own.

    Turns are ordered by ``turn``, NULL first, then by role and text; repeated rows are turns each. A NULL role
    or text is empty; rows without a conversation id belong to none and are left out. A
    conversation may come to have no turn: it ends at the root. No conversations, no nodes. Turns and
    paths are told apart by digests of 256 and 128 bits. One conversation is held by one task, as digests.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    id_ = F.col(conv).cast("long")
    head = F.crc32(id_.cast("string").cast("binary")) % heads if heads else F.lit(0)
    rows = turns.select(id_.alias("conv"), F.col(turn).alias("at"), role_.alias("role"), text_.alias("text"), head.cast("long").alias("heads"))
    family = F.expr(f"conv div {group}")
    dealt = rows.filter("conv is not null").withColumn("family", family).repartitionByRange("family")
    dealt = dealt.sortWithinPartitions("family", "conv", F.asc_nulls_first("at"), "role", "text")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    compact = dealt.select("conv", "heads", digest.alias("turn"), F.octet_length("text").cast("long").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _parts(batches, group, shard)

    parts = written(compact.mapInArrow(
        lean(run), "key binary, parent binary, depth long, n long, low long, ends string, convs array<long>, rest array<long>"), "trie-parts")
    first = F.get("rest", F.lit(0))
    nodes = written(parts.groupBy("key", "parent", "depth").agg(
        F.sum("n").alias("n_convs"), F.min("low").alias("low"), F.min_by(first, "low").alias("rest")), "trie-nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, F.col("key") == F.col("of"), "left").drop("of").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-children")

    # Where a conversation's tail begins, its bytes, and whether its last node is a leaf.
    tails = nodes.groupBy(F.col("low").alias("_low")).agg(
        F.min("depth").alias("top"), F.min_by("rest", "depth").alias("tail"), (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"))
    members = parts.select("key", "depth", F.explode(F.arrays_zip("convs", "rest")).alias("m")).select(
        "key", "depth", F.col("m.convs").alias("conv"), F.col("m.rest").alias("left"))
    members = members.join(tails, F.col("conv") == F.col("_low"), "left")
    below = F.when(F.col("top") <= F.col("depth"), F.col("left")).otherwise(F.coalesce("tail", F.lit(0)))
    sums = members.groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(F.col("left") - below).alias("saved_tokens"))

    listed = parts.filter("ends is not null").select("key", "low", "ends").repartition("key").sortWithinPartitions("key", "low")
    ends = listed.mapInArrow(lean(_ends), "key binary, ends_sha256 string").withColumnRenamed("key", "_end")
    above = nodes.select(F.col("key").alias("_parent"), F.col("low").alias("parent_conv_id"))
    out = nodes.join(sums, F.col("key") == F.col("_key")).join(ends, F.col("key") == F.col("_end"), "left").join(
        above, F.col("parent") == F.col("_parent"), "left")
    return out.select(F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
