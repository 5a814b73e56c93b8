"""Published trigram postings of names, and searches that read them in place of the names.

An index of a table's names is three tables, written with a load and current together with the table:

* entries: each distinct (keys, name) with a dense number, in the order of the keys, which is that
  of the table's files;
* postings: for each trigram and block of 65,536 entries, the sorted places of the entries that have
  it, so that a trigram of a third of all names is many rows and not one;
* totals: entries of each trigram.

A search reads the totals of its own trigrams, then the postings of the rarest, and intersects or
unites them block by block. The entries so found are verified by their text, and the table is read
for those alone: while they are few, as ranges of keys that reach the files' statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.functions import trigram
from regiscope.operators.dedup import with_dense_id
from regiscope.operators.search import gram_sets
from regiscope.plans.publish import DERIVED, write_version
from regiscope.session import work_path

# Column that holds the names, and keys in the order of the table's files.
INDEXED = {
    "empresa": ("razao_social", ("cnpj_basico",)),
    "estabelecimento": ("nome_fantasia", ("uf", "cnpj_basico", "cnpj")),
    "socio": ("nome_socio", ("cnpj_cpf_socio", "cnpj_basico")),
}
BLOCK = 1 << 16
# Rarest trigrams of a text whose postings are intersected; the rest is left to the verification.
RAREST = 4
# Entries up to which the table is read by ranges of their keys, and the most ranges.
FEW, RANGES = 2_000, 64


def index_tables(table: str) -> dict[str, str]:
    """Names of the tables of a table's index."""
    return {part: f"{DERIVED}{table}_{part}" for part in ("nomes", "listas", "totais")}


def write_index(root: str, table: str, df: DataFrame, column: str, keys: Sequence[str], version: str | None = None) -> dict[str, str]:
    """Write the index of the names of a table, return the paths; readers see it after the commit.

    NULL names have no entry. Rows with the same keys and name share one.
    """
    spark, of = df.sparkSession, index_tables(table)
    distinct = df.select(*keys, F.col(column).alias("nome")).filter("nome is not null").distinct()
    entries = with_dense_id(distinct, [*(F.asc_nulls_first(k) for k in keys), "nome"], "linha")
    paths = {of["nomes"]: write_version(entries, root, of["nomes"], cluster_by=("linha",), version=version)}
    entries = spark.read.parquet(paths[of["nomes"]])
    pieces = entries.select(F.floor(F.col("linha") / BLOCK).alias("bloco"), (F.col("linha") % BLOCK).cast("int").alias("lugar"),
                            F.explode(trigram.trigrams(F.col("nome"))).alias("trigrama"))
    # At most a block's entries meet for a trigram.
    lists = pieces.groupBy("trigrama", "bloco").agg(F.sort_array(F.collect_list("lugar")).alias("lugares"))
    paths[of["listas"]] = write_version(lists, root, of["listas"], cluster_by=("trigrama", "bloco"), version=version)
    lists = spark.read.parquet(paths[of["listas"]])
    totals = lists.groupBy("trigrama").agg(F.sum(F.size("lugares")).alias("total"))
    paths[of["totais"]] = write_version(totals, root, of["totais"], cluster_by=("trigrama",), version=version)
    return paths


@dataclass(frozen=True)
class NameIndex:
    """A published table with the index of its names, of one look at the commit log."""

    fact: DataFrame
    column: str
    keys: tuple[str, ...]
    entries: DataFrame
    lists: DataFrame
    totals: DataFrame


def name_index(tables: dict[str, DataFrame], table: str, column: str | None = None, keys: Sequence[str] = ()) -> NameIndex:
    """The index of a table among the published ones; KeyError when it has none."""
    of = index_tables(table)
    known = INDEXED.get(table, (column, tuple(keys)))
    return NameIndex(tables[table], column or known[0], tuple(keys) or known[1], *(tables[of[p]] for p in ("nomes", "listas", "totais")))


def search(index: NameIndex, pattern: str) -> DataFrame:
    """Rows whose name holds the text, in any case; the columns of the table.

    A text that is too short to imply a trigram is looked for in all entries, not in the table.
    """
    grams = trigram.implied_trigrams(pattern)
    held = F.lower("nome").contains(pattern.lower())
    if not grams:
        return _rows(index, index.entries.filter(held))
    totals = _totals(index, grams)
    if len(totals) < len(grams):
        return index.fact.limit(0)
    rarest = sorted(grams, key=lambda g: (totals[g], g))[:RAREST]
    lists = index.lists.filter(F.col("trigrama").isin(rarest)).groupBy("bloco").agg(
        F.sort_array(F.collect_list(F.struct(F.size("lugares").alias("n"), "lugares"))).alias("todas")).filter(F.size("todas") == len(rarest))
    common = F.aggregate(F.slice("todas", 2, len(rarest)), F.col("todas")[0]["lugares"], lambda a, x: F.array_intersect(a, x["lugares"]))
    return _rows(index, _entries(index, lists.select("bloco", F.explode(common).alias("lugar"))).filter(held))


def similar(index: NameIndex, query: str, threshold: float = 0.3) -> DataFrame:
    """Rows whose name is at least ``threshold`` similar to the query, with ``similaridade``.

    A similar name shares at least ``threshold * n`` of the query's n trigrams, so it has one of any
    n less that many, plus one: the rarest are read.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    grams = trigram.query_trigrams(query)
    needed = max(1, math.ceil(threshold * len(grams) - 1e-9))
    totals = _totals(index, grams)
    rarest = sorted(grams, key=lambda g: (totals.get(g, 0), g))[: len(grams) - needed + 1] if grams else []
    lists = index.lists.filter(F.col("trigrama").isin([g for g in rarest if g in totals]))
    found = _entries(index, lists.select("bloco", F.explode("lugares").alias("lugar")).distinct())
    scored = found.withColumn("similaridade", trigram.similarity(F.col("nome"), query, needed)) if grams else found.withColumn(
        "similaridade", F.lit(0.0)).filter(F.lit(False))
    return _rows(index, scored.filter(F.col("similaridade") >= threshold), "similaridade")


def similar_batch(index: NameIndex, queries: DataFrame, query_col: str = "query", threshold: float = 0.3) -> DataFrame:
    """Every row with every distinct query that its name is at least ``threshold`` similar to.

    Each query is joined to the postings of the rarest of its trigrams that a similar name must share one
    of; the names themselves are read for candidates only. Columns: the table's, ``query_col`` and
    ``similaridade``.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    asked = gram_sets(queries, query_col, "_pergunta")
    pieces = asked.select("_pergunta", F.explode("_grams").alias("trigrama")).join(index.totals, "trigrama", "left")
    place = F.struct(F.coalesce("total", F.lit(0)).alias("n"), F.col("trigrama").alias("g"))
    ordered = pieces.groupBy("_pergunta").agg(F.sort_array(F.collect_list(place)).alias("o"))
    needed = F.ceil(F.size("o") * threshold - 1e-9).cast("int")
    rarest = ordered.select("_pergunta", F.explode(F.slice(F.col("o")["g"], F.lit(1), F.size("o") - needed + 1)).alias("trigrama"))
    hits = rarest.join(index.lists, "trigrama").select("_pergunta", "bloco", F.explode("lugares").alias("lugar")).distinct()
    hits = hits.select("_pergunta", (F.col("bloco") * BLOCK + F.col("lugar")).alias("linha"))
    both = index.entries.join(hits, "linha").join(asked.withColumnRenamed("_grams", "_pedidos"), "_pergunta")
    both = both.withColumn("_grams", trigram.trigrams(F.col("nome")))
    shared = F.size(F.array_intersect("_grams", "_pedidos"))
    score = trigram.bound(shared, lambda s: s / (F.size("_grams") + F.size("_pedidos") - s))
    found = both.select(*index.entries.columns, F.col("_pergunta").alias(query_col), score.alias("similaridade"))
    return _rows(index, found.filter(F.col("similaridade") >= threshold), query_col, "similaridade")


def _totals(index: NameIndex, grams: Sequence[str]) -> dict[str, int]:
    """Entries of some trigrams; as many rows as a text has trigrams at most."""
    return {r.trigrama: r.total for r in index.totals.filter(F.col("trigrama").isin(list(grams))).collect()}


def _entries(index: NameIndex, places: DataFrame) -> DataFrame:
    """The entries at places ``(bloco, lugar)``."""
    numbers = places.select((F.col("bloco") * BLOCK + F.col("lugar")).alias("linha"))
    few = numbers.limit(FEW + 1).collect()
    if len(few) > FEW:
        return index.entries.join(numbers, "linha", "left_semi")
    numbers = sorted(r.linha for r in few)
    near = [(F.col("linha") >= run[0]) & (F.col("linha") <= run[-1]) for run in _runs(numbers)]
    return index.entries.filter(_any(near)).filter(F.col("linha").isin(numbers))


def _rows(index: NameIndex, found: DataFrame, *more: str) -> DataFrame:
    """The rows of the table that have the keys and the name of an entry, with its further columns."""
    spark, keys = found.sparkSession, index.keys
    path = work_path(spark, "found")
    found.select("linha", *(F.col(k).alias(f"_{k}") for k in keys), F.col("nome").alias("_texto"), *more).write.parquet(path)
    found = spark.read.parquet(path)
    fact, few = index.fact, found.select("linha", *(f"_{k}" for k in keys)).distinct().limit(FEW + 1).collect()
    if len(few) <= FEW:
        rows = {r.linha: tuple(r)[1:] for r in few}
        fact = fact.filter(_any([_between(keys, rows[run[0]], rows[run[-1]]) for run in _runs(sorted(rows))]))
        found = F.broadcast(found) if not more else found
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(index.column) == F.col("_texto")]
    return fact.join(found, reduce(Column.__and__, same)).select(*(fact[c] for c in fact.columns), *more)


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False)) if conditions else F.lit(False)


def _runs(numbers: list[int]) -> list[list[int]]:
    """Ascending numbers cut at their largest gaps into at most ``RANGES`` runs."""
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[: RANGES - 1]
    edges = [0, *sorted(gaps), len(numbers)]
    return [numbers[a:b] for a, b in zip(edges, edges[1:]) if a < b]


def _between(keys: Sequence[str], low: tuple, high: tuple) -> Column:
    """Keys from one entry's to another's: what the first keys allow, the next where the first are equal."""
    wanted = F.lit(True)
    for key, a, b in zip(keys, low, high):
        if a is None and b is None:
            wanted &= F.col(key).isNull()
        elif a is None:
            return wanted & (F.col(key).isNull() | (F.col(key) <= b))
        else:
            wanted &= (F.col(key) >= a) & (F.col(key) <= b)
        if a != b:
            return wanted
    return wanted
