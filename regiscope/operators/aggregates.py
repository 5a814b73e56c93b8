"""Counts, distributions and the two published aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.functions.ids import optional_int
from regiscope.operators.lookup import decode
from regiscope.schemas import ACTIVE


def _rows():
    return F.count(F.lit(1))


def active(estab: DataFrame) -> DataFrame:
    return estab.filter(F.col("situacao_cadastral") == ACTIVE)


def count_establishments(estab: DataFrame, uf: str | None = None, cnae: object = None,
                         situacao: object = None) -> DataFrame:
    """One row ``total``; every filter that is given and readable narrows the count."""
    wanted = {
        "uf": uf or None,
        "cnae_fiscal_principal": optional_int(cnae),
        "situacao_cadastral": optional_int(situacao),
    }
    rows = estab
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column) == F.lit(value))
    return rows.agg(_rows().alias("total"))


def regime_distribution(regime: DataFrame, ano: object = None, approximate: bool = False) -> DataFrame:
    """Records and distinct companies per form of taxation, most records first.

    The exact distinct is shuffled by (form, company), so a form with most of the rows
    still spreads over all tasks.
    """
    year = optional_int(ano)
    rows = regime if year is None else regime.filter(F.col("ano") == F.lit(year))
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        rows.groupBy("forma_de_tributacao")
        .agg(_rows().alias("registros"), distinct("cnpj_basico").alias("empresas_distintas"))
        .orderBy(F.desc("registros"), F.asc_nulls_last("forma_de_tributacao"))
    )


def regime_summary(regime: DataFrame) -> DataFrame:
    """One row: records, distinct companies, first and last year."""
    return regime.agg(
        _rows().alias("linhas"),
        F.count_distinct("cnpj_basico").alias("empresas"),
        F.min("ano").alias("ano_min"),
        F.max("ano").alias("ano_max"),
    )


def mart_capital_by_category(empresa: DataFrame, category: str = "natureza_juridica_cod",
                             amount: str = "capital_social") -> DataFrame:
    """Companies and total capital per category; the NULL category is a group of its own."""
    return empresa.groupBy(category).agg(
        _rows().alias("empresas"), F.sum(amount).alias("capital_total")
    )


def mart_active_by_place_activity(estab: DataFrame) -> DataFrame:
    """Active establishments per state, municipality and main activity."""
    keys = ("uf", "municipio_cod", "cnae_fiscal_principal")
    return active(estab).groupBy(*keys).agg(_rows().alias("qtd"))


def openings_series(estab: DataFrame, grain: str = "month",
                    start: str = "data_inicio_atividade") -> DataFrame:
    """Openings per day, month, quarter or year of the start date."""
    period = F.to_date(F.date_trunc(grain, F.col(start)))
    return (
        estab.filter(F.col(start).isNotNull())
        .groupBy(period.alias("periodo"))
        .agg(_rows().alias("aberturas"))
    )


def active_by_activity(estab: DataFrame, cnae: object = None) -> DataFrame:
    """Active establishments per main activity, or of one activity."""
    code = optional_int(cnae)
    rows = active(estab)
    if code is not None:
        rows = rows.filter(F.col("cnae_fiscal_principal") == F.lit(code))
    return rows.groupBy("cnae_fiscal_principal").agg(_rows().alias("qtd"))


def by_municipality(estab: DataFrame, dim_municipio: DataFrame) -> DataFrame:
    """Establishments per municipality; the name is looked up after counting."""
    counts = estab.groupBy("municipio_cod").agg(_rows().alias("qtd"))
    return decode(counts, dim_municipio, "municipio_cod", "municipio", text="nome")


def by_size(empresa: DataFrame, dim_porte: DataFrame) -> DataFrame:
    """Companies per size class; the text is looked up after counting."""
    counts = empresa.groupBy("porte_cod").agg(_rows().alias("qtd"))
    return decode(counts, dim_porte, "porte_cod", "porte")


def load_audit(tables: dict[str, DataFrame], names: tuple[str, ...] = (
        "empresa", "estabelecimento", "socio", "simples", "regime_tributario")) -> DataFrame:
    """``(t, count)``: the row count of each fact."""
    counts = [
        tables[name].agg(_rows().alias("count")).select(F.lit(name).alias("t"), "count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def profile_pairs(df: DataFrame, first: str, second: str, approximate: bool = False) -> DataFrame:
    """Distinct values of two columns and of their pairs, and how far each decides the other.

    Rows with a NULL in either column are left out. ``a_decide_b`` is the share of rows whose first
    value occurs with one second value only. The exact form counts pairs first; everything after
    reads one row per pair. The approximate form is a single pass of sketches without the shares.
    """
    present = df.filter(F.col(first).isNotNull() & F.col(second).isNotNull())
    if approximate:
        return present.agg(
            _rows().alias("linhas"),
            F.approx_count_distinct(first).alias("distintos_a"),
            F.approx_count_distinct(second).alias("distintos_b"),
            F.approx_count_distinct(F.struct(first, second)).alias("distintos_par"),
        )
    pairs = present.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(_rows().alias("n"))

    def one_side(key: str) -> DataFrame:
        per_value = pairs.groupBy(key).agg(F.sum("n").alias("n"), _rows().alias("others"))
        return per_value.agg(
            F.lit(key).alias("side"),
            F.sum("n").alias("linhas"),
            _rows().alias("distintos"),
            F.sum(F.when(F.col("others") == 1, F.col("n")).otherwise(0)).alias("decided"),
            F.sum("others").alias("distintos_par"),
        )

    sides = one_side("a").unionByName(one_side("b"))
    of_a, of_b = F.col("side") == "a", F.col("side") == "b"
    return sides.agg(
        F.coalesce(F.max("linhas"), F.lit(0)).alias("linhas"),
        F.max(F.when(of_a, F.col("distintos"))).alias("distintos_a"),
        F.max(F.when(of_b, F.col("distintos"))).alias("distintos_b"),
        F.coalesce(F.max("distintos_par"), F.lit(0)).alias("distintos_par"),
        F.max(F.when(of_a, F.col("decided") / F.col("linhas"))).alias("a_decide_b"),
        F.max(F.when(of_b, F.col("decided") / F.col("linhas"))).alias("b_decide_a"),
    )
