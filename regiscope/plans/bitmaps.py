"""Published bitmaps over dense branch numbers, and counts of branches from them alone.

Branches are numbered in the order of their files. For each (column, code) there are the numbers of the
branches with that code as words of 64 bits; words without any have no row, so a rare code takes no more
rows than it has branches. Codes of one filter are united, those of different filters intersected, word by
word, and bits are counted; branches themselves are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.functions.ids import optional_int
from regiscope.functions.words import PLACE, size, word
from regiscope.operators.dedup import with_dense_id
from regiscope.plans.publish import BITMAPS, write_version
from regiscope.session import work_path

COLUMNS = ("uf", "municipio_cod", "cnae_fiscal_principal", "situacao_cadastral")
# Column name of the secondary activities.
SECONDARY = "cnae_secundario"


def write_bitmaps(root: str, estab: DataFrame, bridge: DataFrame, version: str | None = None) -> dict[str, str]:
    """Write the bitmaps of the branches and of the activities that the bridge lists; returns the path.

    A NULL code is a code of its own. A branch without listed activities is in no bitmap of theirs.
    """
    spark = estab.sparkSession
    path = work_path(spark, "numbers")
    # Written first: numbers must not change when a task runs again.
    with_dense_id(estab.select("cnpj_basico", "cnpj", *COLUMNS), ["uf", "cnpj_basico", "cnpj"], "linha").write.parquet(path)
    numbers = spark.read.parquet(path)
    codes = numbers.select("linha", F.inline(F.array(*(
        F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("codigo")) for c in COLUMNS))))
    listed = bridge.select("cnpj", F.col("cnae_cod").cast("string").alias("codigo")).join(numbers.select("cnpj", "linha"), "cnpj")
    codes = codes.unionByName(listed.select("linha", F.lit(SECONDARY).alias("coluna"), "codigo"))
    words = codes.select("coluna", "codigo", *word("linha"))
    bits = words.groupBy("coluna", "codigo", *PLACE).agg(F.bit_or("bits").alias("bits"))
    return {BITMAPS: write_version(bits, root, BITMAPS, cluster_by=("coluna", "codigo", *PLACE), version=version)}


def _filters(uf: str | None, cnae: object, situacao: object, municipio: object, secondary: bool) -> list[Mapping[str, Sequence[str]]]:
    """For each filter that is given and readable the codes by column, any of which will do."""
    out: list[Mapping[str, Sequence[str]]] = []
    if uf:
        out.append({"uf": [uf]})
    activity, status, place = optional_int(cnae), optional_int(situacao), optional_int(municipio)
    if activity is not None:
        out.append({c: [str(activity)] for c in (COLUMNS[2], *([SECONDARY] if secondary else []))})
    if status is not None:
        out.append({"situacao_cadastral": [str(status)]})
    if place is not None:
        out.append({"municipio_cod": [str(place)]})
    return out


def _one(codes: Mapping[str, Sequence[str]]) -> Column:
    return reduce(Column.__or__, [(F.col("coluna") == c) & F.col("codigo").isin(list(v)) for c, v in codes.items()])


def selected(bits: DataFrame, filters: Sequence[Mapping[str, Sequence[str]]]) -> DataFrame:
    """``(balde, palavra, bits)`` of the branches that pass all filters; empty words are left out.

    Without filters, of all branches: each has one state, be it NULL.
    """
    if not filters:
        return bits.filter(F.col("coluna") == "uf").groupBy(*PLACE).agg(F.bit_or("bits").alias("bits"))
    which = reduce(lambda c, i: c.when(_one(filters[i]), i), range(1, len(filters)), F.when(_one(filters[0]), 0))
    read = bits.filter(reduce(Column.__or__, map(_one, filters))).withColumn("filtro", which)
    each = read.groupBy(*PLACE, "filtro").agg(F.bit_or("bits").alias("bits"))
    both = each.groupBy(*PLACE).agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return both.filter(F.col("n") == len(filters)).select(*PLACE, "bits").filter("bits <> 0")


def count_branches(tables: dict[str, DataFrame], uf: str | None = None, cnae: object = None, situacao: object = None,
                   municipio: object = None, secondary: bool = False) -> DataFrame:
    """One row ``total``, as ``count_establishments`` gives it, with secondary activities if wanted."""
    found = selected(tables[BITMAPS], _filters(uf, cnae, situacao, municipio, secondary))
    return found.agg(size("bits").alias("total"))


def count_by(tables: dict[str, DataFrame], column: str, uf: str | None = None, cnae: object = None, situacao: object = None,
             municipio: object = None, secondary: bool = False) -> DataFrame:
    """``(codigo, qtd)``: the branches that pass the filters, by the codes of a column or of ``SECONDARY``."""
    bits = tables[BITMAPS]
    own = bits.filter(F.col("coluna") == column).select("codigo", *PLACE, "bits")
    filters = _filters(uf, cnae, situacao, municipio, secondary)
    if filters:
        wanted = selected(bits, filters).withColumnRenamed("bits", "_wanted")
        own = own.join(wanted, list(PLACE)).select("codigo", F.col("bits").bitwiseAND(F.col("_wanted")).alias("bits"))
    return own.groupBy("codigo").agg(size("bits").alias("qtd")).filter("qtd > 0")
