"""The trie of conversations, the alignment of tokenizers and the weighted fingerprints against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from regiscope.llm import alignment, prefix_trie, queries, weighted_fingerprint
from tests.conftest import SF_DIR

TURNS = "conv_id long, turn long, role string, text string, key string, parent long, depth long, _low long, n int"


# --- trie of conversations


def rebuilt(rows, heads=9, group=5):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads if heads else 0
        base = c - int(np.fmod(c, group))
        out[c] = (own.get(base, [])[:h] if h else []) + turns[h:]
    return out


def trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    nodes = {}
    for k in members:
        below = [x for x in members if x[: len(k)] == k]
        ends = sorted(c for c in members[k] if len(paths[c]) == len(k))
        nodes[k] = (
            min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]),
            sum(len(x) == len(k) + 1 for x in below), sum(not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in below) for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return sorted(nodes.values(), key=repr)


def trie_rows(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3, 4) for r in rows], TURNS)


@pytest.mark.parametrize("shard", [1, 3, 4096])
def test_trie_equals_brute_force(spark, shard):
    draw = random.Random(shard)
    rows = []
    for c in [*range(-12, 40), 1000, 1003, 10**12 + 1]:
        if draw.random() < 0.85:
            for turn in range(draw.randint(1, 11)):
                text = draw.choice(["hi", "", None, "äö", "same"]) if draw.random() < 0.8 else f"own {c} {turn}"
                rows.append((c, draw.choice([turn, None, 3]), draw.choice(["user", None]) if turn else "user", text))
    rows += rows[:9] + [(None, 1, "user", "of nobody")]
    draw.shuffle(rows)
    for heads in (9, 0):
        got = prefix_trie.prefix_trie(trie_rows(spark, rows), heads=heads, shard=shard).collect()
        assert sorted(map(tuple, got), key=repr) == trie(rebuilt(rows, heads))


def test_trie_of_a_hot_conversation_and_long_ones(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(600) for t in range(3)]
    long = [(5000, t, "user", "ä" * 200_000 if t == 7 else f"t{t}") for t in range(300)]
    rows = copies + long + [(c, 9, "user", f"last {c}") for c in range(0, 600, 7)]
    got = prefix_trie.prefix_trie(trie_rows(spark, rows), shard=64).collect()
    root = next(r for r in got if r.depth == 0)
    assert (root.conv_id, root.n_convs, root.parent_conv_id, root.n_children, root.n_leaves) == (0, 601, None, 2, 87)
    assert root.saved_tokens == 3 * 599 * 6
    node = next(r for r in got if r.depth == 3 and r.conv_id == 0)
    ends = ",".join(str(c) for c in range(600) if c % 7)
    assert node.ends_sha256 == hashlib.sha256(ends.encode()).hexdigest() and node.n_children == 86
    assert sum(r.conv_id == 5000 for r in got) == 300


def test_trie_without_rows_or_turns(spark):
    assert prefix_trie.prefix_trie(trie_rows(spark, []), heads=9).count() == 0
    assert prefix_trie.prefix_trie(trie_rows(spark, [(None, 1, "a", "b")]), heads=9).count() == 0
    # crc32("1") % 9 is 2 and conversation 0 is absent, so 1 loses its only turn.
    alone = prefix_trie.prefix_trie(trie_rows(spark, [(1, 1, "a", "b")]), heads=9).collect()
    assert zlib.crc32(b"1") % 9 > 0 and [tuple(r)[:7] for r in alone] == [(1, 0, None, 1, 0, 1, 0)]


def test_shards_end_between_groups():
    conv = np.repeat(np.arange(40), 3)
    cuts = prefix_trie._cuts(conv, 5, 7)
    assert cuts[0] == 0 and cuts[-1] == 120 and all(conv[c] % 5 == 0 for c in cuts[:-1]) and len(cuts) == 5


# --- alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = [["<|endoftext|>", " ", "x", "<s>", "▁", "<0x41>", "\x00"], "ab .\n", "aB1 .,'\n\t!s", ["é", "日本", "😀", " ", "　", "क़", "\x85", "\x1c", "."]]


@pytest.fixture(scope="module")
def both():
    lib = Tokenizer.from_file(PATHS[0])
    lib.encode_special_tokens = True
    return alignment.Aligner(*PATHS), lib, SentencePieceProcessor(model_file=PATHS[1])


def links_of(both, text):
    """Ids of both, and the places of their linked tokens; None for a text without tokens."""
    own, lib, sp = both
    if not text:
        return None
    a, b = lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    want = (" " + text).encode()
    parts = [[own.bytes_a[i] for i in a], [own.bytes_b[i] for i in b]]
    if any(b"".join(p) != want for p in parts):
        return None
    ends = [np.cumsum([len(x) for x in p]) for p in parts]
    _, i, j = np.intersect1d(*ends, return_indices=True)
    return a, b, i.tolist(), j.tolist()


def groups_of(found):
    a, b, left, right = found
    out, p, q = [], 0, 0
    for i, j in zip(left, right):
        out.append(",".join(map(str, a[p : i + 1])) + "|" + ",".join(map(str, b[q : j + 1])))
        p, q = i + 1, j + 1
    return hashlib.sha256(";".join(out).encode()).hexdigest()


def alignments(both, texts):
    found = [links_of(both, t) for t in texts]
    counts = Counter((a[i], b[j]) for a, b, left, right in filter(None, found) for i, j in zip(left, right))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(f[0][i], f[1][j]) for i, j in zip(f[2], f[3])]
        out.append((len(f[0]), len(f[1]), len(pairs), len(pairs), sum(counts[p] == best[p[1]] for p in pairs),
                    sum(counts[p] for p in pairs), groups_of(f)))
    return out


@pytest.mark.parametrize("lane", [2, 512])
def test_lockstep_equals_brute_force(both, lane, monkeypatch):
    monkeypatch.setattr(alignment.lanes, "__defaults__", (lane,))
    monkeypatch.setattr(alignment, "CHUNK", 2 << 20 if lane > 2 else 3_000)
    draw = random.Random(lane)
    texts = [None, "", "▁", " "] + ["".join(draw.choices(draw.choice(SPECIAL), k=draw.randint(0, 60))) for _ in range(3000)]
    got = [f for some in both[0].align(pa.array(texts, pa.string())) for f in some]
    assert len(got) == len(texts)
    for text, f in zip(texts, got):
        want = links_of(both, text)
        if want is None:
            assert f[:5] == (0, 0, 0, 0, "") and not len(f[5])
        else:
            n = len(want[2])
            assert f[:5] == (len(want[0]), len(want[1]), n, n, groups_of(want))
            pairs = Counter(want[0][i] * 32_000 + want[1][j] for i, j in zip(want[2], want[3]))
            assert dict(zip(f[5].tolist(), f[6].tolist())) == pairs


def test_alignment_of_a_table(spark, both):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).collect()]
    texts += [None, "", " ", "same words here", "same words here", "a▁b", "<|endoftext|> <s>", "long " * 300_000 + "tail\n\n\n"]
    rows = [(i if i else None, t, 1, 2, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair long, _row long, best string")
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, *PATHS).collect()}
    assert got == {i if i else None: want for i, want in enumerate(alignments(both, texts))}
    assert alignment.align(docs.limit(0), *PATHS).count() == 0


def test_pairs_are_bounded_by_the_vocabularies(both):
    own = both[0]
    assert 4 * (sum(map(len, own.bytes_a)) + sum(map(len, own.bytes_b))) < 3_000_000 and all(own.bytes_a) and all(own.bytes_b)


# --- weighted fingerprints


def bag(text):
    return Counter([w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w] or [""])


def likeness(x, y):
    x, y = bag(x), bag(y)
    both_ = sum(min(n, y[k]) for k, n in x.items())
    return both_ / (sum(x.values()) + sum(y.values()) - both_)


def edited(text, after):
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def test_fingerprints_estimate_generalised_jaccard(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in weighted_fingerprint.fingerprints(docs, per=7).collect()}
    assert len(got) == len(rows)
    off, prints = [], defaultdict(set)
    for at, (doc, text) in enumerate(rows):
        after, r = rows[(at + 1) % len(rows)][1], got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited(text, after).encode()).hexdigest()
        off += [(r.near_edited - likeness(text, edited(text, after)), r.near_next - likeness(text, after))]
        prints[text].add(r.fingerprint)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 512
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) >= 0.95 * len(prints)
    off = np.array(off)
    assert np.abs(off.mean(axis=0)).max() < 0.02 and off.std(axis=0).max() < 0.08


def test_fingerprints_of_odd_rows(spark):
    long = " ".join(f"w{i % 50_000}" for i in range(400_000))
    texts = [None, "", " \n\t", "a", "a", "ÀÉ ß ñ 😀", long, "x" * 300_000, "b " * 9, "a b"]
    rows = [(i, t, "c", 1, "d") for i, t in enumerate(texts)] + [(None, "no id", "c", 1, "d"), (3, "a", "c", 1, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, range string, at int, guest string")
    order = [3, 3] + [9, 8, 7, 6, 5, 4, 2, 1, 0]
    order = sorted((r[0] for r in rows if r[0] is not None), reverse=True)
    for per in (1, 4, 1000):
        got = weighted_fingerprint.fingerprints(docs, per=per, samples=16).collect()
        assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((r[0] is None, r[0]) for r in rows)
        by = {r.doc_id: r for r in got}
        after = {d: (order + [None])[k + 1] for k, d in enumerate(order)} | {None: order[0]}
        text = {r[0]: r[1] or "" for r in rows}
        for d, r in by.items():
            if d != 3:
                assert r.edited_sha256 == hashlib.sha256(edited(text[d], text[after[d]]).encode()).hexdigest(), (per, d)
        assert by[0].fingerprint == by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0
        assert by[3].fingerprint == by[4].fingerprint != by[0].fingerprint and by[4].near_next == 1.0
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    alone = weighted_fingerprint.fingerprints(docs.filter("doc_id = 5")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert weighted_fingerprint.fingerprints(docs.limit(0)).count() == 0


def test_fingerprints_of_one_id(spark):
    docs = spark.range(200).selectExpr("if(id < 150, 7L, id) doc_id", "concat('w', id, ' common') text")
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    for some in (docs, nameless):
        got = weighted_fingerprint.fingerprints(some, samples=8, per=5)
        assert got.count() == 200 and got.select("edited_sha256").distinct().count() > 150


def test_weights_matter(spark):
    docs = spark.createDataFrame([(2, "a " * 30 + "b"), (1, "a " * 10 + "b " * 21)], "doc_id long, text string")
    got = {r.doc_id: r for r in weighted_fingerprint.fingerprints(docs, samples=512).collect()}
    assert abs(got[2].near_next - 11 / 51) < 0.08


def test_fingerprints_run_no_python(spark):
    plan = queries.op13_weighted_fingerprint(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD", plan)
