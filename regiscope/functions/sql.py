"""SQL spellings of the cleaning expressions and of the parameterised questions, for users of ``spark.sql``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from regiscope.functions.clean import DATE_FORMAT, NO_DATE


def register_functions(spark: SparkSession) -> None:
    """``parse_date(text)`` as a SQL function; Spark inlines it, so it runs as built-ins do."""
    empty = ", ".join(f"'{v}'" for v in NO_DATE)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION parse_date(s STRING) RETURNS DATE
        RETURN CASE WHEN btrim(s) NOT IN ({empty}) THEN try_to_date(btrim(s), '{DATE_FORMAT}') END""")


# Name, parameters, columns and body of each table function; a parameter that is NULL filters nothing.
_TABLE_FUNCTIONS = (
    ("contar_estabelecimentos", "p_uf STRING DEFAULT NULL, p_cnae INT DEFAULT NULL, p_situacao INT DEFAULT NULL", "total BIGINT", """
        SELECT count(*) FROM estabelecimento
        WHERE (p_uf IS NULL OR uf = p_uf) AND (p_cnae IS NULL OR cnae_fiscal_principal = p_cnae)
          AND (p_situacao IS NULL OR situacao_cadastral = p_situacao)"""),
    ("distribuicao_regimes", "p_ano INT DEFAULT NULL", "forma_de_tributacao STRING, registros BIGINT, empresas_distintas BIGINT", """
        SELECT forma_de_tributacao, count(*), count(DISTINCT cnpj_basico) FROM regime_tributario
        WHERE p_ano IS NULL OR ano = p_ano GROUP BY forma_de_tributacao"""),
    ("ranking_capital", "p_limite INT DEFAULT NULL", "posicao INT, natureza_juridica STRING, empresas BIGINT, capital_total DECIMAL(28,2)", """
        SELECT * FROM (
          SELECT row_number() OVER (ORDER BY capital_total DESC NULLS LAST, natureza_juridica_cod NULLS LAST), descricao, empresas, capital_total
          FROM mart_capital_by_category LEFT JOIN dim_natureza_juridica ON codigo = natureza_juridica_cod) AS r(posicao, n, e, c)
        WHERE p_limite IS NULL OR posicao <= p_limite"""),
    ("rede_socio", "p_doc STRING", "cnpj_basico STRING, razao_social STRING, nome_socio STRING, qualificacao STRING", """
        SELECT s.cnpj_basico, razao_social, nome_socio, descricao FROM socio s
        LEFT JOIN empresa e ON e.cnpj_basico = s.cnpj_basico
        LEFT JOIN dim_qualificacao ON codigo = qualificacao_socio_cod WHERE cnpj_cpf_socio = p_doc"""),
    ("filial", "p_cnpj STRING, p_uf STRING DEFAULT NULL",
     "cnpj STRING, uf STRING, razao_social STRING, situacao STRING, cnae_principal STRING, municipio STRING, natureza_juridica STRING", """
        SELECT b.cnpj, b.uf, razao_social, s.descricao, c.descricao, m.nome, n.descricao
        FROM (SELECT *, row_number() OVER (PARTITION BY cnpj ORDER BY uf) AS primeira FROM estabelecimento
              WHERE cnpj = p_cnpj AND (p_uf IS NULL OR uf = p_uf)) b
        LEFT JOIN empresa e ON e.cnpj_basico = b.cnpj_basico
        LEFT JOIN dim_situacao_cadastral s ON s.codigo = b.situacao_cadastral
        LEFT JOIN dim_cnae c ON c.codigo = b.cnae_fiscal_principal
        LEFT JOIN dim_municipio m ON m.codigo = b.municipio_cod
        LEFT JOIN dim_natureza_juridica n ON n.codigo = e.natureza_juridica_cod
        WHERE primeira = 1"""),
)


def register_queries(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Table functions of the parameterised questions over the tables, which become temporary views; returns their names.

    Spark inlines them, so a filter by an argument reaches the scan. A function is left out when a table it
    reads is not there.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    made = []
    for name, parameters, columns, body in _TABLE_FUNCTIONS:
        if set(re.findall(r"(?:FROM|JOIN) ([a-z]\w+)", body)) <= set(tables):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}")
            made.append(name)
    return made
