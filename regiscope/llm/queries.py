"""Registered queries of the operators, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.llm import (
    alignment,
    decontaminate,
    embedding_dedup,
    language_id,
    line_dedup,
    packing,
    prefix_trie,
    records,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
    weighted_fingerprint,
)
from regiscope.llm.common import remainder, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held))
    return language_id.identify(docs, model, ["doc_id", held.alias("held_out")])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their site's boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = line_dedup.drop_boilerplate(docs)
    return found.select("doc_id", "source", F.col("_dropped").alias("n_dropped"), "text")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), words=3, budget=3)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return toxicity.score(docs, toxicity.fit(docs, labels.filter(~held)), ["doc_id", held.alias("held_out")])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return records.token_files(table(spark, sf_dir, "documents"), path, end_id=2)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, end_id=1)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), heads=9)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op13_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprint.fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_line_dedup, op3_embedding_dedup, op4_simhash, op5_warc, op6_toxicity,
    op7_decontaminate, op8_token_records, op9_suffix_dedup, op10_packing,
    op11_prefix_trie, op12_alignment, op13_weighted_fingerprint,
)}

_STRIP = "regexp_replace({x}, '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g')"

ORACLE = {
    "op2_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
 l AS (SELECT r, source, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
       FROM d WHERE text IS NOT NULL),
 b AS (SELECT r, source, i, line, {_STRIP.format(x='line')} AS bare FROM l),
 n AS (SELECT source, count(*) AS total FROM d GROUP BY source),
 f AS (SELECT source, bare, count(DISTINCT r) AS pages FROM b WHERE bare <> '' GROUP BY source, bare),
 bad AS (SELECT f.source, f.bare FROM f JOIN n ON f.source IS NOT DISTINCT FROM n.source
         WHERE pages >= {line_dedup.MIN_PAGES} AND pages > {line_dedup.RATIO} * total),
 m AS (SELECT b.r, b.i, b.line, bad.bare IS NOT NULL AS hit
       FROM b LEFT JOIN bad ON b.bare = bad.bare AND b.source IS NOT DISTINCT FROM bad.source),
 k AS (SELECT r, count(*) FILTER (hit) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT hit) AS kept FROM m GROUP BY r)
SELECT d.doc_id, d.source, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text
FROM d LEFT JOIN k USING (r)""",
    "op3_embedding_dedup": f"""
WITH RECURSIVE u AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
       AND len(a.v) = len(b.v)
       WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= {embedding_dedup.THRESHOLD}),
 reach AS (SELECT a AS n, a AS m FROM e UNION SELECT reach.n, e.b FROM reach JOIN e ON reach.m = e.a),
 c AS (SELECT n, min(m) AS component FROM reach GROUP BY n),
 k AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = n LEFT JOIN k ON vec_id = a""",
    "op5_warc": f"""
WITH p AS (SELECT page_id, regexp_replace(url, '\\s+', '', 'g') AS url, coalesce(encode(html), ''::BLOB) AS body FROM pages),
 q AS (SELECT page_id, url, octet_length(body) AS n, sha1(body) AS d FROM p),
 g AS (SELECT *, CASE WHEN n >= {warc.REVISIT_FROM} THEN max(page_id) OVER (PARTITION BY d, n) ELSE page_id END AS last FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NOT DISTINCT FROM page_id THEN NULL ELSE last END AS refers_to, url
FROM g""",
    "op7_decontaminate": r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
           FROM documents),
 t AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
       FROM benchmark),
 tw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS g
        FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
              FROM t WHERE len(ws) > 0)),
 ns AS (SELECT DISTINCT n FROM tw),
 dw AS (SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g
        FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, ns WHERE len(ws) >= n)),
 hits AS (SELECT dw.r, dw.i, dw.n, tw.item_id FROM dw JOIN tw ON dw.g = tw.g AND dw.n = tw.n),
 places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
 items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
           FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN places USING (r) LEFT JOIN items USING (r)""",
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
 o AS (SELECT c, list({'role': role, 'text': text} ORDER BY i) AS own FROM t GROUP BY c),
 h AS (SELECT c, own, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
         lambda a, b: list_reduce([xor(a, b)] || [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
           lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 9 AS n FROM o),
 r AS (SELECT h.c, coalesce(b.own[1 : h.n], []) || h.own[h.n + 1 :] AS path FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5),
 p AS (SELECT c, len(path) AS full_length, unnest(range(0, len(path) + 1)) AS d, path FROM r),
 q AS (SELECT c, full_length, d, path[1 : d] AS k, CASE WHEN d > 0 THEN path[1 : d - 1] END AS up,
         CASE WHEN d > 0 THEN strlen(path[d].text) ELSE 0 END AS bytes FROM p),
 n AS (SELECT k, any_value(up) AS up, any_value(d) AS d, any_value(bytes) AS bytes, min(c) AS low, count(*) AS n_convs,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (full_length = d), '') AS ends FROM q GROUP BY k),
 kids AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
 m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.up = n.k),
 a AS (SELECT k[1 : e] AS k, n_children, (n_convs - 1) * bytes AS saved
       FROM (SELECT k, n_children, n_convs, bytes, unnest(range(0, d + 1)) AS e FROM m)),
 s AS (SELECT k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM a GROUP BY k)
SELECT m.low::BIGINT AS conv_id, m.d::BIGINT AS depth, above.low::BIGINT AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s ON s.k = m.k LEFT JOIN m above ON above.k = m.up""",
}
