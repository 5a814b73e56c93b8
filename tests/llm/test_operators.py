"""Operators against brute force, round trips and edge rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiscope.llm import (
    decontaminate, embedding_dedup, language_id, line_dedup, packing, queries, records, simhash, suffix_dedup,
    toxicity, warc,
)
from regiscope.llm.components import components
from regiscope.llm.tokens import Encoder
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, text2 string, item_id long"
ODD = [None, "", " \n\t", "a", "a b", "ÀÉ ß ñ", "x" * 5000, "\n".join(["same line"] * 40), "αβγ 日本語 😀", "12 34 ,.;"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, 1, "clash", 7) for i, t in enumerate(ODD)]
    rows += [(None, "no id at all here", None, None, None, None, None, None)] + [rows[3]] * 3 + [rows[6]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    pairs += [(7, 7), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- language identification, toxicity


def test_language_held_out(spark):
    docs = docs_of(spark)
    got = queries.op1_language_id(spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 20 and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark, odd, empty):
    model = language_id.fit(docs_of(spark))
    got = language_id.identify(odd, model, ["doc_id", "text"]).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r.lang_pred == "und") == (r.text is None or not any(map(str.isalpha, r.text)))
    none = language_id.fit(empty)
    assert none.languages == [] and {r.lang_pred for r in language_id.identify(odd, none, ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(empty, model, ["doc_id"]).count() == 0


def test_very_many_languages(spark):
    docs = spark.range(2400).selectExpr("concat('wort ', cast(id % 1200 as string), ' a') as text", "cast(id % 1200 as string) as lang")
    model = language_id.fit(docs, sample=1500)
    assert len(model.languages) == 1200 and model.weights.shape[1] == 1200


def test_gram_counts_do_not_depend_on_parts(monkeypatch):
    text = "Ein Satz, der über Teile geht. " * 30
    whole = language_id.grams(text)
    monkeypatch.setattr(language_id, "_PART", 64)
    assert all(np.array_equal(a, b) for a, b in zip(whole, language_id.grams(text)))


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3))
    p = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert 3.0 < language_id.temperature(true * 4, y) < 5.01


def test_factorization_learns_a_pair():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(1500):
        has = rng.random(2) < 0.5
        at = np.array([i for i in (0, 1) if has[i]] + [2 + int(rng.integers(20))], np.int64)
        rows.append((int(has.all()), at))
    bias, w, v = toxicity.train(rows, 22, epochs=20)
    both, one = toxicity.margin(np.array([0, 1, 5]), bias, w, v)[0], toxicity.margin(np.array([0, 5]), bias, w, v)[0]
    assert both > 0 > one and v[0] @ v[1] > 0.5


def test_toxicity_edges(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model, ["doc_id"]).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.fit(empty, labels.limit(0)).score("x") == 0.5
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0


def test_toxicity_query(spark):
    got = queries.op6_toxicity(spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 200


# --- lines


def test_lines_joined_equal_lines_sent(spark, odd, empty):
    docs = docs_of(spark).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    few = line_dedup.drop_boilerplate(docs, ratio=0.05, min_pages=2)
    many = line_dedup.drop_boilerplate(docs, ratio=0.05, min_pages=2, limit=0)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    assert few.agg(F.sum("_dropped")).first()[0] > 0
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_lines_of_one_host(spark):
    rows = [(i, f"menu\nown {i}\n  menu ", "h") for i in range(6)] + [(9, "menu\nx", "other"), (10, None, "h")]
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].text == "own 0" and got[0]._dropped == 2 and got[9].text == "menu\nx" and got[10].text is None


def test_lines_of_a_small_host_and_clashing_columns(spark):
    rows = [(i, f"menu\nown {i}", "small", [i], f"x{i}", i) for i in range(4)] + [(9, "menu\nalone", "single", [], "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _drop array<int>, _host string, _row long")
    for limit in (50_000, 0):
        got = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, limit=limit).collect()}
        assert [got[i].text for i in range(4)] == [f"own {i}" for i in range(4)] and got[9].text == "menu\nalone"
        assert [(got[i]._drop, got[i]._host, got[i]._row, got[i]._dropped) for i in range(4)] == [([i], f"x{i}", i, 1) for i in range(4)]
    other = line_dedup.drop_boilerplate(docs.withColumn("_dropped", F.lit("old")))
    assert other.columns == [*docs.columns, "_dropped"] and other.agg(F.sum("_dropped")).first()[0] == 4


def test_lines_are_bared_of_blanks_and_tabs_only(spark):
    rows = [(i, f" menu\t\nown {i}\nmenu \u2028", "h") for i in range(6)]
    got = line_dedup.boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert [r.pages for r in got.collect()] == [6, 6]


# --- embeddings


def test_pivots_of_very_many_labels(spark):
    rows = spark.range(6000).selectExpr("id", "cast(id % 2000 as int) label", "array(rand(1), rand(2), id + 1D) vec")
    pivots = embedding_dedup._pivots(rows, 1, 4096)
    assert len(pivots) == 2000 and all(0 < len(p) <= 3 for p in pivots.values())


def test_embeddings_by_pivots_and_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] * (1 + i % 3) + rng.normal(size=8) * 0.1).astype(float).tolist(), i % 2) for i in range(600)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)]
    rows += [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [float("nan")] * 8, 0), (2003, [1.0, None], 0),
             (2004, rows[0][1], None), (2005, [1e300] * 8, 1), (2006, [2e300] * 8, 1), (2007, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("size", F.lit("clash"))
    use = [r for r in rows if r[0] < 2000 or r[0] in (2005, 2006)]
    x = np.array([r[1] for r in use])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab, ids = np.array([r[2] for r in use]), [r[0] for r in use]
    near = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(near, False)
    comp = np.arange(len(ids))
    for _ in range(len(ids)):
        low = np.array([min(comp[i], comp[near[i]].min(initial=comp[i])) for i in range(len(ids))])
        if (low == comp).all():
            break
        comp = low
    want = {ids[i]: (int(near[i].sum()), ids[comp[i]]) for i in range(len(ids))}
    want |= {r[0]: (0, r[0]) for r in rows if r[0] not in want}
    for cell, cell_rows in ((10_000, 6000), (20, 6000), (20, 9)):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(
            df, cell=cell, cell_rows=cell_rows).collect()}
        assert got == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_pivots_of_one_direction(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=64).astype(np.float32)
    copies = [base * np.float32(k) for k in rng.uniform(0.2, 5, 300)]
    x = np.array(copies + [base + rng.normal(size=64).astype(np.float32) * np.float32(0.12) for _ in range(300)])
    unit = embedding_dedup._unit(x.astype(np.float64))
    near = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, cell=50).collect()}
    assert near.min() < 599 and got == dict(enumerate(near.tolist()))


# --- SimHash


def brute_simhash(text, n=3):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_simhash_against_brute_force(spark, odd):
    docs = docs_of(spark).select("doc_id", "text").unionByName(
        odd.filter("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    rows = [(r.doc_id, brute_simhash(r.text)) for r in docs.collect()]
    comp = {d: d for d, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if (x ^ y).bit_count() <= 3:
                r, s = sorted((find(a), find(b)))
                comp[s] = r
    want = Counter((d, f"{x:016x}", find(d)) for d, x in rows)
    for subtree in (20_000, 2):
        assert Counter(map(tuple, simhash.simhash_groups(docs, subtree=subtree).collect())) == want


def test_walk_finds_every_pair():
    rng = np.random.default_rng(0)
    seeds = rng.integers(0, 1 << 63, 30).astype(np.uint64)
    values = np.unique(np.concatenate([seeds ^ np.uint64(1 << int(k)) ^ np.uint64(1 << int(j)) for k, j in rng.integers(0, 64, (30, 2))]))
    got = {tuple(sorted((int(a), int(c)))) for f in simhash.walk(values, np.array([[0, len(values)] * 2]), 3) for a, _, c, _ in f}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j}


def test_node_pairs_beyond_the_budget_go(spark):
    values = np.random.default_rng(6).integers(0, 1 << 30, 40).tolist() + [0, 7 << 56, 15 << 56, 1 << 50]
    rows = spark.createDataFrame([(v, 0, v, "0", 0, 0) for v in values], "id long, rot int, turned long, node string, side int, spent int")
    once = simhash._split(rows, 0, 3)
    twice = simhash._split(once, simhash.STEP, 3).collect()
    assert once.count() == 42 * len(values) and len(twice) == 299 * len(values) and max(r.spent for r in twice) == 3


def test_near_copies(spark, odd, empty):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(900)]
    base = [rng.choices(vocabulary, k=400) for _ in range(20)]
    rows = []
    for k, words in enumerate(base):
        for c in range(5):
            copy = list(words)
            for _ in range(4):
                copy[rng.randrange(400)] = "changed"
            rows.append((k * 10 + c, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d // 10 * 10 for d, _ in rows}
    assert simhash.near_copies(odd).count() == odd.count() and simhash.near_copies(empty).count() == 0
    assert simhash.simhash_groups(odd).count() == odd.count() and simhash.simhash_groups(empty).count() == 0


def test_near_copies_by_sets_of_shingles(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    text = lambda n: [word() for _ in range(n)]
    line, base = text(7), text(400)
    rows = [(1, text(200) + line * 30), (2, text(200) + line * 30)]  # nothing alike but one repeated line
    rows += [(3, base + line), (4, base + line * 60)]  # alike but for the repeats of one line
    for k in range(40):  # around the limit: some candidates by bits are no links
        kept = text(160)
        rows += [(100 + 2 * k, kept + text(10 + k // 2)), (101 + 2 * k, kept + text(10 + k // 2))]
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in rows}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert got[1] == 1 and got[2] == 2 and got[4] == 3
    assert all(like[a, d] >= 0.8 for d, a in got.items() if a != d)
    assert all(got[b] == got[a] for (a, b), s in like.items() if s >= 0.88)


def test_rows_joined_through_others():
    # In one leaf 0 is linked to 1, 1 to 2 and so on, but 0 to no other; 1 000 lies apart.
    at = np.append(np.arange(0, 100), 1000)
    rows = pd.DataFrame({"rot": 0, "node": "0", "side": 0, "turned": 0, "id": at, "n": 1, "w0": [
        ((1 << int(i) % 50) - 1) if i < 50 else 0 for i in at], "w1": [((1 << int(i) - 50) - 1) if 50 <= i < 100 else 0 for i in at],
        "w2": [int(50 <= i < 100) * ((1 << 50) - 1) for i in at], "w3": [-1 if i == 1000 else 0 for i in at]})
    bits = rows[["w0", "w1", "w2", "w3"]].to_numpy().view(np.uint64)
    links = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) <= 3
    want = connected(links)
    out = simhash._forest(rows, 3, simhash.Wide(["w0", "w1", "w2", "w3"], 3, 0.8)).to_pydict()
    place = {int(v): i for i, v in enumerate(at)}
    tree = np.zeros_like(links)
    for a, b in zip(out["a"], out["b"]):
        assert links[place[a], place[b]]
        tree[place[a], place[b]] = tree[place[b], place[a]] = True
    assert connected(tree) == want and 1 < len(set(want)) < len(at)


def connected(near):
    comp = list(range(len(near)))
    for _ in comp:
        comp = [min([comp[i], *(comp[j] for j in np.flatnonzero(near[i]))]) for i in range(len(near))]
    return comp


# --- WARC


def test_warc_segments_and_edges(spark):
    rows = [(1, "http://a/ b", "é" * 3000), (2, None, None), (3, "u", "é" * 3000), (None, "u", "é" * 3000), (4, "u", "x" * 999),
            (5, "u", "x" * 999), (6, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (6, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (7, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.archive(pages, segment_bytes=500).collect()}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = {(p, "revisit" if p in (1, None) else "response", 3 if p in (1, None) else None, len((t or "").encode()), sha(t))
            for p, _, t in rows}
    assert got == want
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_reports_damage():
    data = b"".join(r + b"\r\n\r\n" for r in warc.records_of(1, 1, "u", b"a" * 3000, None, 1000))
    assert len(list(warc.parsed(data))) == 4
    with pytest.raises(ValueError):
        list(warc.parsed(data[:1200] + data[1210:]))
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabcdeXX0\r\n\r\n")
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


# --- decontamination


def test_decontamination_in_blocks(spark, odd, empty):
    docs = docs_of(spark).select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").unionByName(spark.createDataFrame(
        [(None, "a b"), (900, None), (901, " ,;"), (902, "No id AT all"), (902, "same line same line")], "item_id long, text string"))
    bench = bench.unionByName(bench.filter("item_id is null or item_id > 900"))
    one = sorted(map(tuple, decontaminate.report(docs, bench).collect()), key=repr)
    four = sorted(map(tuple, decontaminate.report(docs, bench, block_bytes=3000).collect()), key=repr)
    assert one == four and len(one) == docs.count()
    by = {r[0]: r for r in one if r[0] is None}
    assert by[None][2:4] == (4, 1)
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(empty, bench).count() == 0
    clean = decontaminate.keep_clean(odd, bench)
    assert clean.columns == odd.columns and clean.filter("doc_id is null").count() == 0


# --- tokens, records, packing


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(spark, name):
    import pyarrow as pa

    odd = [*ODD[1:], "  a  b ", "a\n\nb", "İstanbul ΣΑΣ", "<|endoftext|> hi <|startoftext|>x", "don't I'll it's. 's", "1234 5.6,7",
           "é a ́b", "ﬁ ½ ² Ⅷ ª º", "a\tb c\r\nd", "a b c  d", "x.,., ... ,a .b", "ab.\ncd", "a \x01b", "\x02. a.\x02",
           "\x1cab", "a . b", "ab. cd, ef.\ngh", "a.\n.b", "les&&& for.--x"]
    texts = odd + [r.text for r in docs_of(spark).limit(60).collect()]
    enc, lib = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(enc.encode(t), enc.dtype).tolist() for t in texts] == want
    got = []
    for ids, stops in enc.encode_many(pa.array(texts)):
        got += [p.tolist() for p in np.split(ids, stops[:-1])]
    assert got == want


ALPHABETS = ["ab .\n", "aB1 .,'\n\t!s", "İiIşŞA.,' \n", "é e\u0301.,\u0958\u0915\u093c\n!ſﬁ", "İ\u0307Ia .\n\x85\x1c\u3000日本。",
             "abc   \n\n..,,'\"-_1\x01\x02", [".\n", "\n\n", " ", "word", "Two", "'s", "'ll", "3", "...", "\r\n", "ΑΣ", "Σ"]]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library_on_random_texts(name, monkeypatch):
    import random

    import pyarrow as pa

    monkeypatch.setattr("regiscope.llm.tokens.REMEMBERED", 1 << 20)
    draw = random.Random(11)
    texts = ["".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(0, 24))) for _ in range(100_000)]
    texts += ["hello world\n\n", "hello world.\n\n", "a b\n\n\nc d", "one two \n\n", "Title here\n\n\n\nBody text",
              "İ.", "A. İ. Kaya", "ALİ.", "NİHAİ, son"]
    enc, lib = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    got = []
    for ids, stops in enc.encode_many(pa.array(texts)):
        got += [p.tolist() for p in np.split(ids, stops[:-1])]
    assert got == want
    assert all(np.frombuffer(enc.encode(t), enc.dtype).tolist() == w for t, w in zip(texts[-2000:], want[-2000:]))


def test_a_vocabulary_is_held_once():
    enc = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert enc.spaced is not enc and enc.spaced.tokenizer is enc.tokenizer and enc.spaced.model is enc.model
    assert enc.spaced.plain is enc and enc.spaced.spaced is enc.spaced


def test_stages_hand_texts_on_in_small_batches(spark, sf):
    import corpus_pipeline as p

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "n"])

    texts = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("ab cd "), 5_000).alias("text"))
    for name, stage in p.STAGES:
        for key in p.BATCHES:
            spark.conf.unset(key)
        stage(spark, spark.read.parquet(f"{sf}/documents.parquet").limit(20), sf)
        got = texts.mapInArrow(sizes, "size long, n long").collect()
        assert sum(r.n for r in got) == 600 and max(r.size for r in got) < 3 << 20, name
    for key in p.BATCHES:  # an application's own setting stays
        spark.conf.set(key, "7777")
        p.small_batches(spark)
        assert spark.conf.get(key).startswith("7777")
        spark.conf.unset(key)


def test_records_round_trip(spark, odd, empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    docs = docs_of(spark).select("doc_id", "text").unionByName(odd.select((F.col("doc_id") + 500).alias("doc_id"), "text"))
    index = records.token_files(docs, path, 2, str(tmp_path / "r"))
    got = sorted(index.collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == [False] + [True] * (len(got) - 1)
    assert [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = defaultdict(set)
    for r in docs.collect():
        ids[r.doc_id].add(tuple(lib.encode(r.text or "", add_special_tokens=False).ids + [2]))
    assert all(r.ids_crc32 in {zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids[r.doc_id]} for r in got)
    some = index.filter("doc_id % 7 = 0")
    assert {(r.doc_id, tuple(r.ids)) for r in records.read_at(spark, str(tmp_path / "r"), some).collect()} <= {
        (d, i) for d in ids for i in ids[d]}
    assert records.token_files(empty, path, 2, str(tmp_path / "e")).count() == 0


def test_records_report_damage():
    data = records.frame(5, b"\1\0\2\0", 2) + b"\n" + records.frame(None, b"", 2) + b"\n"
    assert [(d, i.tolist()) for _, _, d, i in records.records(data)] == [(5, [1, 2]), (None, [])]
    for at in (0, 9, 15, 24):
        with pytest.raises(ValueError):
            list(records.records(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))


def check_pieces(rows, ids_of, window=2048):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(by[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    fill = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        fill.append(at)
    assert sorted(sequences) == list(range(len(sequences))) and max(fill) <= window
    assert sum(f < window for f in fill) <= 1


def test_packing(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    docs = docs_of(spark)
    check_pieces(packing.pack(docs, path, 1).collect(),
                 {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()})
    got = packing.pack(odd, path, 1, window=16)
    assert got.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).filter("n % doc_tokens <> 0").count() == 0
    assert packing.pack(empty, path, 1).count() == 0


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(4)
    for counts in ({1500: 1000}, {2048: 3}, {1: 5}, dict(Counter(rng.integers(1, 2049, 5000).tolist()))):
        made, seen = packing.plan(counts), defaultdict(list)
        for n, c in counts.items():
            sequence, offset = packing.place(made, np.full(c, n), np.arange(c))
            for s, o in zip(sequence.tolist(), offset.tolist()):
                seen[s].append((o, o + n))
        marks = np.zeros(2048 * (max(seen) + 2), int)
        for s, spans in seen.items():
            for a, b in spans:
                marks[s * 2048 + a : s * 2048 + b] += 1
        assert marks.max() == 1 and marks.sum() == sum(n * c for n, c in counts.items())


# --- suffixes


def brute_repeats(texts, length):
    count = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    out = []
    for b in texts:
        hit = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                hit[k : k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~hit])
        out.append((len(b), int(hit.sum()), int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [8000, 1])
def test_suffixes_against_brute_force(spark, odd, group):
    rng = random.Random(9)
    shared = ["".join(rng.choices("abcdé ", k=k)) for k in (30, 45, 60, 200)]
    rows = [(i, "".join(rng.choice([rng.choice(shared), "".join(rng.choices("abc", k=rng.randrange(40)))]) for _ in range(8)))
            for i in range(150)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(300, "z" * 700), (301, "z" * 49), (302, "z" * 50), (303, rows[4][1]), (None, "q" * 60)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=50, gram=12, group=group)
    want = Counter((r[0], *w) for r, w in zip(rows, brute_repeats([(t or "").encode() for _, t in rows], 50)))
    assert Counter(map(tuple, got.collect())) == want


def test_suffixes_edges(spark, odd, empty):
    assert suffix_dedup.remove_repeats(odd, keep_text=True).count() == odd.count()
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_collision_is_noticed():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, (40, 30), dtype=np.uint8)
    data[20:] = data[:20]
    args = (data, np.full(40, 10), np.full(40, 20), np.zeros(40, np.int64))
    assert np.array_equal(suffix_dedup.repeated(*args, length=20, gram=10), suffix_dedup._by_bytes(*args, 20, 10))
    order = suffix_dedup.suffix_order(data, suffix_dedup.prefix_hashes(data), 10, args[3])
    rows = [data[i, 10:].tobytes() for i in order]
    assert rows == sorted(rows)


# --- pipeline


def test_pipeline_stages(spark, odd, empty):
    import corpus_pipeline as p

    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert stage(spark, empty.select(*docs.columns), SF_DIR).count() == 0
    kept = p.drop_near_copies(spark, docs, SF_DIR)
    assert kept.filter("doc_id = 3").count() == 1 and kept.filter("text is null or trim(text) = ''").count() == 1
    assert p.pack_sequences(spark, docs, SF_DIR).agg(F.countDistinct("doc_id")).first()[0] == len(ODD)


def test_pipeline_runs(spark):
    import corpus_pipeline as p

    check = p.run(spark, SF_DIR)
    assert check.count() > 0 and check.filter("length < 1 or offset + length > 2048").count() == 0


def test_thinned_links_keep_their_components(spark):
    rng = np.random.default_rng(5)
    ends = rng.integers(0, 60, (400, 2)) + 100 * rng.integers(0, 5, (400, 1))
    crowd = np.stack([np.repeat(np.arange(3), 200), 1000 + np.tile(np.arange(200), 3)], axis=1) + 10_000
    pairs = np.concatenate([ends[ends[:, 0] < ends[:, 1]], crowd])
    links = spark.createDataFrame(pairs.tolist(), "a long, b long").distinct()
    thin = simhash._thinned(links)
    assert thin.exceptAll(links).isEmpty()
    assert thin.filter("a >= 10000").count() == 200 + 2
    assert {tuple(r) for r in components(thin).collect()} == {tuple(r) for r in components(links).collect()}


def test_near_copies_that_fail_the_sets_make_no_rows(spark, monkeypatch):
    """A crowd whose texts are candidates of each other, but similar to the first few only."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]

    def changed(n):
        words = list(base)
        for at in rng.choice(120, n, replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        return " ".join(words)

    texts = [changed(int(rng.integers(1, 4))) for _ in range(400)]
    rows, made = [(i, t) for i, t in enumerate(texts)], {}
    kept = simhash.written

    def counted(df, name, batch=None):
        out = kept(df, name, batch)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(simhash, "written", counted)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    for i, c in got.items():
        assert c == i or any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(400) if j != i and got[j] == c)
    assert len(made["pairs"]) == 1 and made["pairs"][0] < 8 * 400 and len(made["candidates"]) <= 2
    assert all(n <= 32 * 400 for n in made["candidates"])
