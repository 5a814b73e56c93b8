"""Name search: substring and trigram similarity; reverse lookup by activity."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.functions import trigram


def name_search(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose name holds the text, in any case."""
    return df.filter(F.lower(column).contains(pattern.lower()))


def name_similarity(df: DataFrame, column: str, query: str, threshold: float = 0.3) -> DataFrame:
    """Rows whose name is at least ``threshold`` similar to the query, with ``similaridade``.

    The union is never smaller than the query's own set, so a name below
    ``threshold * |query|`` shared trigrams cannot qualify. That test is plain substring
    matching; only its survivors have their trigram arrays built. A name is normalised once.
    """
    wanted = len(trigram.query_trigrams(query))
    if wanted == 0:
        return df.withColumn("similaridade", F.lit(0.0)).filter(F.lit(False))
    needed = max(1, math.ceil(threshold * wanted - 1e-9))
    scored = df.withColumn("similaridade", trigram.similarity(F.col(column), query, needed))
    return scored.filter(F.col("similaridade") >= threshold)


def name_similarity_batch(df: DataFrame, column: str, queries: DataFrame, query_col: str = "query",
                          threshold: float = 0.3) -> DataFrame:
    """Every row with every distinct query that its name is at least ``threshold`` similar to.

    The columns are those of ``df``, ``query_col`` and ``similaridade``. Each distinct text has its
    trigrams put in one order, rarest first; two sets that are similar enough share one of their
    first ``size - ceil(threshold * size) + 1``, so only these are joined. Candidates are pairs of
    distinct texts; full rows come in after the threshold. ``threshold`` must be above 0.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    names = gram_sets(df, column, "_name")
    asked = gram_sets(queries, query_col, "_query")
    counts = names.select(F.explode("_grams").alias("_gram")).groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rare = [_rarest(sets, text, counts, threshold) for sets, text in ((names, "_name"), (asked, "_query"))]
    pairs = rare[0].join(rare[1], "_gram").select("_name", "_query").distinct()
    both = pairs.join(names, "_name").join(asked.withColumnRenamed("_grams", "_wanted"), "_query")
    shared = F.size(F.array_intersect("_grams", "_wanted"))
    score = trigram.bound(shared, lambda s: s / (F.size("_grams") + F.size("_wanted") - s))
    found = both.select("_name", F.col("_query").alias(query_col), score.alias("similaridade")).filter(
        F.col("similaridade") >= threshold)
    return df.join(found, F.col(column) == F.col("_name")).drop("_name")


def gram_sets(df: DataFrame, column: str, text: str) -> DataFrame:
    """``(text, _grams)`` of the distinct texts that have trigrams."""
    texts = df.select(F.col(column).alias(text)).filter(F.col(text).isNotNull()).distinct()
    return texts.withColumn("_grams", trigram.trigrams(F.col(text))).filter(F.size("_grams") > 0)


def _rarest(sets: DataFrame, text: str, counts: DataFrame, threshold: float) -> DataFrame:
    """``(text, _gram)``: of each set the trigrams one of which a similar set must share."""
    pieces = sets.select(text, F.explode("_grams").alias("_gram")).join(counts, "_gram", "left")
    place = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))
    ordered = pieces.groupBy(text).agg(F.sort_array(F.collect_list(place)).alias("_o"))
    needed = F.ceil(F.size("_o") * threshold - 1e-9).cast("int")
    first = F.slice(F.col("_o")["gram"], F.lit(1), F.size("_o") - needed + 1)
    return ordered.select(text, F.explode(first).alias("_gram"))


def establishments_by_activity(estab: DataFrame, bridge: DataFrame, code: int,
                               include_primary: bool = True) -> DataFrame:
    """Branches with the activity, each once; ``origem`` tells main from secondary.

    Two scans, both cut short: the branches with it as their main activity by a filter that reaches the
    files, the others by a semi join to the branches that the bridge lists for it.
    """
    having = bridge.filter(F.col("cnae_cod") == code).select("cnpj")
    is_primary = F.col("cnae_fiscal_principal") == F.lit(code)
    others = estab if not include_primary else estab.filter(~is_primary | F.col("cnae_fiscal_principal").isNull())
    listed = others.join(having, "cnpj", "left_semi").select(*estab.columns, F.lit("secundaria").alias("origem"))
    if not include_primary:
        return listed
    return estab.filter(is_primary).withColumn("origem", F.lit("principal")).unionByName(listed)
