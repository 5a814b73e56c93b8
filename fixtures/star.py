"""Registry-shaped tables over the star-schema test tables.

Each table is one projection, written in SQL that Spark and DuckDB both read, so that a query
and its check start from the same rows. Companies come from ``customer``, branches from
``orders``, partners and tax regimes from ``lineitem``, flags from ``labels``, lookups from
``nation``, ``region`` and ``part``. Some codes have no lookup row, some are NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regiscope.schemas import DOMAINS, FILE, LINE
from regiscope.sources.domains import domain_dim

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "labels",
           "documents", "events")


def _id(column: str, width: int = 8) -> str:
    return f"lpad(CAST({column} AS STRING), {width}, '0')"


def _day(column: str) -> str:
    return f"replace(CAST(CAST({column} AS DATE) AS STRING), '-', '')"


TYPED = {
    "empresa": f"""
        SELECT {_id('c_custkey')} AS cnpj_basico, c_name AS razao_social,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    ELSE CAST(c_nationkey + 3 AS SMALLINT) END AS natureza_juridica_cod,
               CAST(c_custkey % 60 AS SMALLINT) AS qualificacao_resp_cod,
               CAST(c_acctbal AS DECIMAL(18, 2)) AS capital_social,
               CAST(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'BUILDING' THEN 1
                    WHEN 'AUTOMOBILE' THEN 3 WHEN 'MACHINERY' THEN 5 ELSE 7 END AS SMALLINT) AS porte_cod,
               CAST(NULL AS STRING) AS ente_federativo
        FROM {{customer}}""",
    "estabelecimento": f"""
        SELECT {_id('o_custkey')} || {_id('o_orderkey % 1000000', 6)} AS cnpj,
               {_id('o_custkey')} AS cnpj_basico,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 < 3 THEN CAST(1 AS SMALLINT)
                    ELSE CAST(2 AS SMALLINT) END AS matriz_filial,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Loja ' || o_orderpriority END AS nome_fantasia,
               CAST(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 8 ELSE 9 END AS SMALLINT)
                   AS situacao_cadastral,
               CAST(o_orderdate AS DATE) AS data_situacao_cadastral,
               CAST(o_orderkey % 40 AS SMALLINT) AS motivo_situacao_cod,
               CAST(NULL AS STRING) AS nome_cidade_exterior, CAST(NULL AS SMALLINT) AS pais_cod,
               CAST(o_orderdate AS DATE) AS data_inicio_atividade,
               CAST(o_orderkey % 2500 AS INT) AS cnae_fiscal_principal,
               'RUA' AS tipo_logradouro, 'Rua ' || CAST(o_custkey % 97 AS STRING) AS logradouro,
               CAST(o_orderkey % 999 AS STRING) AS numero, CAST(NULL AS STRING) AS complemento,
               'Centro' AS bairro, {_id('o_orderkey')} AS cep,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'SP' WHEN '2-HIGH' THEN 'RJ'
                    WHEN '3-MEDIUM' THEN 'MG' WHEN '4-NOT SPECIFIED' THEN 'EX' ELSE '??' END AS uf,
               CAST(o_custkey % 30 AS INT) AS municipio_cod,
               '11' || {_id('o_orderkey')} AS ddd_telefone_1,
               CAST(NULL AS STRING) AS ddd_telefone_2, CAST(NULL AS STRING) AS ddd_fax,
               'c' || CAST(o_custkey AS STRING) || '@x.br' AS email,
               CAST(NULL AS STRING) AS situacao_especial, CAST(NULL AS DATE) AS data_situacao_especial
        FROM {{orders}}""",
    "estabelecimento_cnae_secundario": f"""
        SELECT {_id('l_orderkey')} || '000100' AS cnpj, CAST(l_partkey AS INT) AS cnae_cod
        FROM {{lineitem}}""",
    "socio": f"""
        SELECT {_id('l_partkey')} AS cnpj_basico,
               CAST(l_linenumber % 3 + 1 AS SMALLINT) AS identificador_socio,
               'Supplier#' || {_id('l_suppkey', 9)} AS nome_socio,
               '***' || {_id('l_suppkey', 6)} || '**' AS cnpj_cpf_socio,
               CAST(l_linenumber AS SMALLINT) AS qualificacao_socio_cod,
               CAST(l_shipdate AS DATE) AS data_entrada_sociedade,
               CAST(NULL AS SMALLINT) AS pais_cod, CAST(NULL AS STRING) AS cpf_representante,
               CAST(NULL AS STRING) AS nome_representante,
               CAST(NULL AS SMALLINT) AS qualificacao_repr_cod,
               CAST(l_orderkey % 12 AS SMALLINT) AS faixa_etaria_cod
        FROM {{lineitem}}""",
    "simples": f"""
        SELECT {_id('doc_id')} AS cnpj_basico,
               quality = 1 AS opcao_simples, CAST('2010-01-31' AS DATE) AS data_opcao_simples,
               CAST(NULL AS DATE) AS data_exclusao_simples,
               toxic = 1 AS opcao_mei, CAST(NULL AS DATE) AS data_opcao_mei,
               CAST(NULL AS DATE) AS data_exclusao_mei
        FROM {{labels}}""",
    "regime_tributario": f"""
        SELECT {_id('l_partkey')} || {_id('l_linenumber', 4)} || {_id('l_suppkey % 100', 2)} AS cnpj,
               {_id('l_partkey')} AS cnpj_basico,
               CAST(year(l_shipdate) AS SMALLINT) AS ano,
               CASE l_returnflag WHEN 'A' THEN 'LUCRO REAL' WHEN 'N' THEN 'LUCRO PRESUMIDO'
                    ELSE 'IMUNE DO IRPJ' END AS forma_de_tributacao,
               CAST(l_quantity AS INT) AS qtd_escrituracoes, CAST(NULL AS STRING) AS cnpj_da_scp
        FROM {{lineitem}}""",
    "dim_natureza_juridica":
        "SELECT CAST(n_nationkey AS SMALLINT) AS codigo, n_name AS descricao FROM {nation}",
    "dim_municipio":
        "SELECT CAST(n_nationkey AS INT) AS codigo, n_name AS nome FROM {nation}",
    "dim_qualificacao":
        "SELECT CAST(r_regionkey AS SMALLINT) AS codigo, r_name AS descricao FROM {region}",
    "dim_cnae":
        "SELECT CAST(p_partkey AS INT) AS codigo, p_name AS descricao FROM {part}",
}

# All-text feeds with the irregularities the cleaning has to deal with.
STAGING = {
    "empresas": f"""
        SELECT CASE WHEN c_custkey % 97 = 0 THEN '1234567' WHEN c_custkey % 89 = 0 THEN 'ABCD1234'
                    ELSE {_id('c_custkey')} END AS cnpj_basico,
               CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END AS razao_social,
               CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(c_nationkey AS STRING) END AS natureza_juridica,
               {_id('c_custkey % 60', 2)} AS qualificacao_resp,
               CASE WHEN c_custkey % 17 = 0 THEN ''
                    ELSE replace(CAST(CAST(c_acctbal AS DECIMAL(18, 3)) AS STRING), '.', ',') END AS capital_social,
               CASE c_mktsegment WHEN 'BUILDING' THEN '01' WHEN 'AUTOMOBILE' THEN '03'
                    WHEN 'MACHINERY' THEN '05' WHEN 'HOUSEHOLD' THEN '00' ELSE '' END AS porte,
               '' AS ente_federativo,
               'customer' AS {FILE}, c_custkey + 1 AS {LINE}
        FROM {{customer}}""",
    "estabelecimentos": f"""
        SELECT CASE WHEN o_orderkey % 101 = 0 THEN '123' ELSE {_id('o_custkey')} END AS cnpj_basico,
               {_id('o_orderkey % 20', 4)} AS cnpj_ordem, '07' AS cnpj_dv,
               CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 < 3 THEN '1' ELSE '2' END
                   AS identificador_matriz_filial,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Loja ' || o_orderpriority END AS nome_fantasia,
               CASE o_orderstatus WHEN 'F' THEN '02' WHEN 'O' THEN '08' ELSE '04' END AS situacao_cadastral,
               CASE o_orderkey % 9 WHEN 0 THEN '0' WHEN 1 THEN '00000000' WHEN 2 THEN '' WHEN 3 THEN ' '
                    WHEN 4 THEN NULL ELSE {_day('o_orderdate')} END AS data_situacao_cadastral,
               '0' AS motivo_situacao, '' AS nome_cidade_exterior, '' AS pais,
               {_day('o_orderdate')} AS data_inicio_atividade,
               CAST(o_orderkey % 2500 AS STRING) AS cnae_principal,
               CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL
                    ELSE CAST(o_custkey AS STRING) || ',,' || {_id('o_custkey', 7)} || ', '
                         || CAST(o_orderkey % 50 AS STRING) || ' ,x' END AS cnae_secundaria,
               'RUA' AS tipo_logradouro, '' AS logradouro, CAST(o_orderkey % 999 AS STRING) AS numero,
               '' AS complemento, 'Centro' AS bairro, {_id('o_orderkey')} AS cep,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'SP ' WHEN '2-HIGH' THEN 'RJ' WHEN '3-MEDIUM' THEN ''
                    WHEN '4-NOT SPECIFIED' THEN 'EX' ELSE '  ' END AS uf,
               CAST(o_custkey % 30 AS STRING) AS municipio,
               CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '11' END AS ddd_1,
               CASE o_orderkey % 8 WHEN 0 THEN '' ELSE {_id('o_orderkey')} END AS telefone_1,
               '' AS ddd_2, '' AS telefone_2, ' ' AS ddd_fax, ' ' AS fax,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'c@x.br' END AS correio_eletronico,
               '' AS situacao_especial, '' AS data_situacao_especial,
               'orders' AS {FILE}, o_orderkey + 1 AS {LINE}
        FROM {{orders}}""",
    "socios": f"""
        SELECT {_id('l_partkey')} AS cnpj_basico, CAST(l_linenumber % 3 + 1 AS STRING) AS identificador_socio,
               'Supplier#' || {_id('l_suppkey', 9)} AS nome_socio,
               CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE '***' || {_id('l_suppkey', 6)} || '**' END
                   AS cnpj_cpf_socio,
               {_id('l_linenumber', 2)} AS qualificacao_socio, {_day('l_shipdate')} AS data_entrada_sociedade,
               CASE WHEN l_linenumber = 1 THEN '105' ELSE '' END AS pais, '' AS cpf_representante,
               '' AS nome_representante, '00' AS qualificacao_repr, CAST(l_orderkey % 10 AS STRING) AS faixa_etaria,
               'lineitem' AS {FILE}, l_orderkey + 1 AS {LINE}
        FROM {{lineitem}}""",
    "simples": f"""
        SELECT {_id('doc_id')} AS cnpj_basico,
               CASE WHEN quality = 1 THEN 'S' ELSE 'n' END AS opcao_simples,
               '20100131' AS data_opcao_simples, '00000000' AS data_exclusao_simples,
               CASE WHEN toxic = 1 THEN 's' WHEN quality = 0 THEN 'X' ELSE '' END AS opcao_mei,
               '' AS data_opcao_mei, '0' AS data_exclusao_mei,
               'labels' AS {FILE}, doc_id + 1 AS {LINE}
        FROM {{labels}}""",
    "regime": f"""
        SELECT CASE WHEN l_orderkey % 31 = 0 THEN '' ELSE CAST(year(l_shipdate) AS STRING) END AS ano,
               CASE WHEN l_orderkey % 37 = 0 THEN {_id('l_partkey')} || '12345'
                    ELSE substring({_id('l_partkey')}, 1, 2) || '.' || substring({_id('l_partkey')}, 3, 3) || '.'
                         || substring({_id('l_partkey')}, 6, 3) || '/' || {_id('l_linenumber', 4)} || '-07' END AS cnpj,
               CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN '12.345.678/0001-95'
                    ELSE '12345678000195' END AS cnpj_da_scp,
               CASE l_returnflag WHEN 'A' THEN 'LUCRO REAL' WHEN 'N' THEN 'LUCRO PRESUMIDO'
                    ELSE 'IMUNE DO IRPJ' END AS forma_de_tributacao,
               CASE WHEN l_linenumber = 4 THEN '' ELSE CAST(l_linenumber AS STRING) END
                   AS quantidade_de_escrituracoes,
               'lineitem' AS {FILE}, l_orderkey + 1 AS {LINE}
        FROM {{lineitem}}""",
    "naturezas": f"""
        SELECT CASE WHEN n_nationkey % 10 = 9 THEN 'x' WHEN n_nationkey % 2 = 0
                    THEN {_id('n_nationkey', 3)} ELSE CAST(n_nationkey % 8 AS STRING) END AS codigo,
               n_name AS descricao, 'nation' AS {FILE}, CAST(n_nationkey + 1 AS BIGINT) AS {LINE}
        FROM {{nation}}""",
    "cnaes": f"""
        SELECT CASE WHEN p_partkey % 50 = 0 THEN ' 1' WHEN p_partkey % 50 = 1 THEN ''
                    ELSE {_id('p_partkey % 1500', 7)} END AS codigo,
               p_name AS descricao, 'part' AS {FILE}, p_partkey + 1 AS {LINE}
        FROM {{part}}""",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _build(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {n: source(spark, sf_dir, n) for n in SOURCES if "{" + n + "}" in text}
    return spark.sql(text, **used)


# Table of each feed, and its column that ``_line`` follows.
ARRIVES = {
    "empresas": ("customer", "c_custkey"), "estabelecimentos": ("orders", "o_orderkey"),
    "socios": ("lineitem", "l_orderkey"), "simples": ("labels", "doc_id"), "regime": ("lineitem", "l_orderkey"),
    "naturezas": ("nation", "n_nationkey"), "cnaes": ("part", "p_partkey"),
}


def arriving(spark: SparkSession, sf_dir: str, feed: str, parts: Callable[[DataFrame], int]) -> DataFrame:
    """A feed in the order of arrival, cut into ``parts`` of its table. Rows are ranged before they become
    text, so that finding the ranges makes none and the shuffle moves the table's own columns.
    """
    name, key = ARRIVES[feed]
    rows = source(spark, sf_dir, name)
    ranged = rows.repartitionByRange(parts(rows), key).sortWithinPartitions(key)
    return spark.sql(STAGING[feed], **{name: ranged})


def typed(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named registry tables; domain dimensions by their own names."""
    return {
        n: domain_dim(spark, n) if n in DOMAINS else _build(spark, sf_dir, TYPED[n]) for n in names
    }


def staging(spark: SparkSession, sf_dir: str, *feeds: str) -> dict[str, DataFrame]:
    return {f: _build(spark, sf_dir, STAGING[f]) for f in feeds}


def with_sql(*names: str) -> str:
    """``WITH`` clause that defines the same tables for DuckDB; feeds are named ``stg_<feed>``."""
    plain = {n: n for n in SOURCES}
    parts = []
    for name in names:
        if name in DOMAINS:
            rows = ", ".join(f"(CAST({code} AS SMALLINT), '{text}')" for code, text in DOMAINS[name])
            parts.append(f"{name}(codigo, descricao) AS (VALUES {rows})")
        elif name.startswith("stg_"):
            parts.append(f"{name} AS ({STAGING[name[4:]].format(**plain)})")
        else:
            parts.append(f"{name} AS ({TYPED[name].format(**plain)})")
    return "WITH " + ",\n".join(parts) + "\n"
