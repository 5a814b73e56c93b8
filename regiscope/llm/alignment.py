"""Alignment of two tokenizers' tokens by the bytes they stand for.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model. A encodes a text
with a blank before it, B puts one there itself, so the tokens of both stand for the same bytes. Where
tokens of both end at the same byte they are linked, and the text is cut there into groups.

The token ends of a batch's documents lie in two flat arrays. One state vector holds a pointer into each
for every document; a step compares the ends at all pointers at once, emits links and cuts where they
are equal, moves on whichever is behind, and takes out the documents that are done. A long document
takes several places of the state vector: it is divided at some byte where tokens of both end, which is
a cut anyway.

Links end together, so one token's bytes are a suffix of the other's: a token has at most as many
partners among the shorter tokens as it has bytes, twice that with single-byte pieces. All distinct pairs of a
corpus are thus at most four times the bytes of both vocabularies, and a table of them is sent to
all executors, however large the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import lean, written
from regiscope.llm.tokens import encoder, joined

# Bytes of text aligned at a time, and tokens of A after which a document is divided.
CHUNK = 2 << 20
LANE = 512
# Tokens of A that are tried for a division.
TRIED = 32
# Bytes of words and their pieces that a worker remembers.
PIECES = 48 << 20
# Texts whose blanks do not each begin a word.
_RUNS = "  |\\A[ \\n]| \\z| \\n|\u2581"


def lockstep(a: np.ndarray, b: np.ndarray, low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray,
             high_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, j)`` with ``a[i] == b[j]`` of ascending ends, i and j in the same lane, ordered.

    Lane k has ``a[low_a[k]:high_a[k]]`` and ``b[low_b[k]:high_b[k]]``.
    """
    live = (low_a < high_a) & (low_b < high_b)
    i, j, end_i, end_j = (x[live].copy() for x in (low_a, low_b, high_a, high_b))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(i):
        x, y = a[i], b[j]
        hit = x == y
        left.append(i[hit])
        right.append(j[hit])
        i += x <= y
        j += y <= x
        live = (i < end_i) & (j < end_j)
        if not live.all():
            i, j, end_i, end_j = i[live], j[live], end_i[live], end_j[live]
    left, right = np.concatenate(left), np.concatenate(right)
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def lanes(a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, ...]:
    """Bounds of lanes: the documents, those of over ``lane`` tokens divided where both have an end."""
    counts = np.diff(start_a)
    inner = np.maximum(counts - 1, 0) // lane
    doc = np.repeat(np.arange(len(counts)), inner)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    at = (start_a[doc] + nth * lane - 1)[:, None] + np.arange(TRIED)
    at = np.minimum(at, (start_a[doc + 1] - 1)[:, None])
    place = np.minimum(np.searchsorted(b, a[at]), max(len(b) - 1, 0))
    same = b[place] == a[at] if len(b) else np.zeros(at.shape, bool)
    first = same.argmax(axis=1)
    rows = np.flatnonzero(same.any(axis=1))
    cut_a, cut_b = at[rows, first[rows]] + 1, place[rows, first[rows]] + 1
    edge_a, edge_b = np.unique(np.r_[start_a, cut_a]), np.unique(np.r_[start_b, cut_b])
    return edge_a[:-1], edge_a[1:], edge_b[:-1], edge_b[1:]


class Pieces:
    """Ids of texts by a sentencepiece model.

    A blank stands at a piece's beginning or not at all, and a line break in no piece, so the ids of a text
    are those of its words, a word behind a line break being taken with it. Distinct words are
    remembered up to a bound of bytes. Texts with runs of blanks, or under a model of another kind, go through whole.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(n) for n in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        probe = self.model.encode(["a  b ", " a", "\n"])
        apart = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        kept = all(b"".join(self.bytes[i] for i in ids) == t for ids, t in zip(probe, (b" a  b ", b"  a", b" \n")))
        self.by_word = apart and kept and len(probe[2]) == 2
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.dtype).tobytes() for ids in self.model.encode(texts, num_threads=1)] if texts else []

    def _words(self, words: np.ndarray) -> list[bytes]:
        if self.held > PIECES:
            self.known, self.held = {}, 0
        new = [w for w in words if w not in self.known]
        for word, ids in zip(new, self._packed(new)):
            # Behind a line break there is no blank.
            self.known[word] = ids[self.dtype.itemsize :] if word[:1] == "\n" else ids
            self.held += 2 * len(word) + len(ids) + 190
        return [self.known[w] for w in words]

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, none of which is NULL, and where each text's end."""
        odd = pc.match_substring_regex(texts, _RUNS).to_numpy(zero_copy_only=False) if self.by_word else np.ones(len(texts), bool)
        odd = odd | pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        lines = pc.replace_substring(pc.if_else(pa.array(odd), "", texts), "\n", " \n")
        ids, stops = joined(lines, self._words, self.dtype)
        if odd.any():
            parts = np.split(ids, stops[:-1])
            at = np.flatnonzero(odd).tolist()
            for i, own in zip(at, self._packed([texts[i].as_py() for i in at])):
                parts[i] = np.frombuffer(own, self.dtype)
            ids, stops = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, stops


def _spelled(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The texts of ids one after another, as bytes, and where each begins, and the last ends."""
    taken = table.take(pa.array(ids))
    return memoryview(taken.buffers()[2] or b"").cast("B"), np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]


class Aligner:
    """Both tokenizers with the bytes and the written ids of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = encoder(path_a, specials=False), Pieces(path_b)
        byte_of = {letter: byte for byte, letter in self.a.letters.items()}
        self.bytes_a = [b""] * self.a.tokenizer.get_vocab_size(True)
        for token, n in self.a.tokenizer.get_vocab(True).items():
            known = all(c in byte_of for c in token)
            self.bytes_a[n] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.bytes_b = self.b.bytes
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.table_a, self.table_b = pa.array(self.bytes_a, pa.large_binary()), pa.array(self.bytes_b, pa.large_binary())
        # An id of A with what follows inside and at the end of its group, one of B, and at the end of all.
        signs = [f"{n}{c}" for n in range(len(self.bytes_a)) for c in ",|"]
        signs += [f"{n}{c}" for n in range(len(self.bytes_b)) for c in (",", ";", "")]
        self.signs = pa.array(signs, pa.large_string())

    def align(self, texts: pa.Array) -> Iterator[list[tuple]]:
        """For each text, some texts at a time: ``(n_a, n_b, n_groups, n_links, digest, pairs, times)``."""
        at = 0
        for ids, stops in self.a.encode_many(texts, spaced=True, chunk=CHUNK):
            some = texts.slice(at, len(stops)).fill_null("")
            at += len(stops)
            yield self._chunk(some, ids, np.concatenate(([0], stops)), *self.b.encode_many(some))

    def _chunk(self, texts: pa.Array, a: np.ndarray, start_a: np.ndarray, b: np.ndarray, stop_b: np.ndarray) -> list[tuple]:
        out: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
        start_b = np.concatenate(([0], stop_b))
        said_a, edge_a = _spelled(self.table_a, a)
        said_b, edge_b = _spelled(self.table_b, b)
        good = np.zeros(len(texts), bool)
        for i, text in enumerate(texts.cast(pa.binary())):
            text = text.as_py()
            want = b" " + text
            good[i] = (len(text) > 0 and said_a[edge_a[start_a[i]] : edge_a[start_a[i + 1]]] == want
                       and said_b[edge_b[start_b[i]] : edge_b[start_b[i + 1]]] == want)
        kept = np.flatnonzero(good)
        if not len(kept):
            return out
        n_a, n_b = np.diff(start_a), np.diff(start_b)
        a, b = a[np.repeat(good, n_a)].astype(np.int64), b[np.repeat(good, n_b)].astype(np.int64)
        start_a, start_b = np.cumsum(np.r_[0, n_a[kept]]), np.cumsum(np.r_[0, n_b[kept]])
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        i, j = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, start_a, start_b))
        # Every cut ends a group of both, and a document ends with a cut.
        cut_a, cut_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        cut_a[i], cut_b[j] = 1, 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        signs = np.empty(len(a) + len(b), np.int64)
        last_b = cut_b.copy()
        last_b[start_b[1:] - 1] = 2
        signs[np.arange(len(a)) + np.r_[0, j + 1][group_a]] = 2 * a + cut_a
        signs[np.arange(len(b)) + (i + 1)[group_b]] = 2 * len(self.bytes_a) + 3 * b + last_b
        written_, place = _spelled(self.signs, signs)
        pairs = a[i] * len(self.bytes_b) + b[j]
        links = np.searchsorted(i, start_a)
        for k, doc in enumerate(kept.tolist()):
            digest = hashlib.sha256(written_[place[start_a[k] + start_b[k]] : place[start_a[k + 1] + start_b[k + 1]]]).hexdigest()
            n = int(links[k + 1] - links[k])
            own, times = np.unique(pairs[links[k] : links[k + 1]], return_counts=True)
            out[doc] = (int(n_a[doc]), int(n_b[doc]), n, n, digest, own, times)
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two vocabulary files; it outlives the task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_row, key, n_a, n_b, n_groups, n_links, groups_sha256, pairs)`` of every row; ``pairs`` its distinct
    linked ids as ``id of A * ids of B + id of B`` and how often each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
        for batch in batches:
            at = 0
            for found in both.align(batch.column(1)):
                sizes = np.cumsum([0, *(len(f[5]) for f in found)])
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *(f[n] for f in found)]).astype(np.int64))
                                                   for n in (5, 6)], fields=list(kind.value_type))
                lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), flat)
                counts = [pa.array([f[n] for f in found], pa.int64()) for n in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(found)), *counts, pa.array([f[4] for f in found], pa.string()), lists],
                    names=[key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])
                at += len(found)

    rows = docs.select(F.col(key), F.col(text))
    kind = rows.schema[key].dataType.simpleString()
    done = rows.mapInArrow(lean(run), f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                      "pairs array<struct<pair:bigint,times:bigint>>")
    return written(done.withColumn("_row", F.monotonically_increasing_id()), "alignments", batch=1_000)


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: tokens of both, groups, links, the digest of the groups, ``n_best`` links whose pair is the most
    frequent of its id of B in all rows (ties included), and ``count_sum`` of the pairs' counts over its links.

    A text that is NULL or empty, or whose bytes either tokenizer does not give back, has no tokens: zeros and
    an empty digest. Repeated rows are rows of their own and count each; a NULL key is kept. Long texts are
    encoded whole. An empty table gives no rows.
    """
    from sentencepiece import SentencePieceProcessor

    parts = aligned(docs, path_a, path_b, key, text)
    ids_b = SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = parts.select(F.inline("pairs")).groupBy("pair").agg(F.sum("times").alias("count"))
    of_b = Window.partitionBy(F.col("pair") % ids_b)
    # Bounded by the vocabularies, see above.
    weights = written(counts.withColumn("best", (F.col("count") == F.max("count").over(of_b)).cast("long")), "pair-counts")
    links = parts.select("_row", F.inline("pairs")).join(F.broadcast(weights), "pair")
    sums = links.groupBy(F.col("_row").alias("_of")).agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return parts.join(sums, F.col("_row") == F.col("_of"), "left").select(
        key, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256")
