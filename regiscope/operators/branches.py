"""Branch view: a branch with its company and the decoded texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.functions.clean import base_id
from regiscope.operators.dedup import keep_first
from regiscope.operators.lookup import decode

COLUMNS = (
    "cnpj", "cnpj_basico", "razao_social", "nome_fantasia", "matriz_filial", "situacao",
    "data_situacao_cadastral", "data_inicio_atividade", "cnae_principal", "tipo_logradouro",
    "logradouro", "numero", "complemento", "bairro", "cep", "municipio", "uf",
    "ddd_telefone_1", "email", "capital_social", "natureza_juridica",
)


def decode_branches(tables: dict[str, DataFrame], estab: DataFrame) -> DataFrame:
    """Branches with the texts of status, kind, activity and municipality; the kind's code
    stays behind as ``matriz_filial_cod``."""
    rows = estab.withColumnRenamed("matriz_filial", "matriz_filial_cod")
    rows = decode(rows, tables["dim_matriz_filial"], "matriz_filial_cod", "matriz_filial")
    rows = decode(rows, tables["dim_situacao_cadastral"], "situacao_cadastral", "situacao")
    rows = decode(rows, tables["dim_cnae"], "cnae_fiscal_principal", "cnae_principal")
    return decode(rows, tables["dim_municipio"], "municipio_cod", "municipio", text="nome")


def branch_view(tables: dict[str, DataFrame], cnpj: str | None = None, uf: str | None = None,
                first: Sequence[str] | None = None) -> DataFrame:
    """Every branch, or the one with the given id, next to its company.

    A state reads one partition. An id is pushed to both scans (the company's key is part of
    it) and yields a single row, the first by state. Over all branches the only wide join is
    the one with the company; adaptive execution splits the branches of a hot company. ``first`` keeps one
    row of each id, the first by state and then by these columns, NULLs first.
    """
    estab, empresa = tables["estabelecimento"], tables["empresa"]
    if uf:
        estab = estab.filter(F.col("uf") == uf)
    if cnpj is not None:
        if len(cnpj) != 14:
            raise ValueError("a branch id has 14 characters")
        estab = keep_first(estab.filter(F.col("cnpj") == cnpj), ["cnpj"], ["uf"])
        empresa = empresa.filter(F.col("cnpj_basico") == base_id(F.lit(cnpj)))
    elif first is not None:
        estab = keep_first(estab, ["cnpj"], ["uf", *first])
    company = empresa.select("cnpj_basico", "razao_social", "capital_social", "natureza_juridica_cod")
    rows = estab.join(company, "cnpj_basico", "left")
    rows = decode_branches(tables, rows)
    rows = decode(rows, tables["dim_natureza_juridica"], "natureza_juridica_cod", "natureza_juridica")
    return rows.select(*COLUMNS)
