"""The registered queries and the SQL each is checked against.

A query runs the library's functions over registry-shaped projections of the test tables
(``fixtures.star``), always over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import star
from fixtures.archives import write_archives
from regiscope.functions import clean, ids
from regiscope.operators import (
    aggregates, branches, dedup, documents, frequent, lookup, network, quality, sample, search, transform,
)
from regiscope.plans import bitmaps, cube, incremental, load, marts, name_index, publish, sketches
from regiscope.schemas import (
    ARRIVAL, FACT_FEEDS, FACT_KEYS, FEED_GLOBS, STAGING_COLUMNS, STAGING_SCHEMAS, TYPED_COLUMNS,
)
from regiscope.session import work_path
from regiscope.sources import feeds
from regiscope.sources.zipcsv import open_fs
from regiscope.streaming import snapshots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _sql(*tables: str) -> str:
    return star.with_sql(*tables)


def _text(dim: str, code: str, text: str = "descricao") -> str:
    """The text of a code, as a scalar subquery."""
    return f"(SELECT {text} FROM {dim} WHERE codigo = {code})"


# --- aggregates and rankings -------------------------------------------------------------

_MART_SQL = """SELECT natureza_juridica_cod, count(*) AS empresas,
       CAST(sum(capital_social) AS DOUBLE) AS capital_total FROM empresa GROUP BY 1"""


_RANKING_SQL = _sql("empresa", "dim_natureza_juridica") + f"""
SELECT {_text('dim_natureza_juridica', 'natureza_juridica_cod')} AS natureza_juridica, empresas, capital_total
FROM ({_MART_SQL}) ORDER BY capital_total DESC NULLS LAST, natureza_juridica_cod LIMIT """


@query("e8_capital_ranking", _RANKING_SQL + "10")
def capital_ranking(spark, sf):
    return _doubles(marts.capital_ranking(star.typed(spark, sf, "empresa", "dim_natureza_juridica"),
                                          ids.clamp_limit(None, marts.DEFAULT_LIMIT, marts.MAX_LIMIT)), "capital_total")


@query("g1_top_categories", _RANKING_SQL + "3")
def top_categories(spark, sf):
    tables = star.typed(spark, sf, "empresa", "dim_natureza_juridica")
    return _doubles(marts.capital_ranking(tables, ids.clamp_limit("3", marts.DEFAULT_LIMIT, marts.MAX_LIMIT)), "capital_total")


@query("e2_capital_by_category", _sql("empresa") + _MART_SQL)
def capital_by_category(spark, sf):
    mart = aggregates.mart_capital_by_category(star.typed(spark, sf, "empresa")["empresa"])
    return _doubles(mart, "capital_total")


@query("e1_count_establishments", _sql("estabelecimento") + "SELECT count(*) AS total FROM estabelecimento")
def count_all(spark, sf):
    return aggregates.count_establishments(star.typed(spark, sf, "estabelecimento")["estabelecimento"])


_FILTERS = (
    ("uf", {"uf": "SP"}, "uf = 'SP'"),
    ("cnae", {"cnae": "17"}, "cnae_fiscal_principal = 17"),
    ("situacao", {"situacao": "2"}, "situacao_cadastral = 2"),
    ("all", {"uf": "RJ", "cnae": "18", "situacao": "8"},
     "uf = 'RJ' AND cnae_fiscal_principal = 18 AND situacao_cadastral = 8"),
    ("unreadable", {"uf": "", "cnae": "abc", "situacao": "1.5"}, "true"),
    ("none match", {"uf": "ZZ"}, "uf = 'ZZ'"),
)


@query("c4_optional_filters", _sql("estabelecimento") + " UNION ALL ".join(
    f"SELECT '{name}' AS filtro, count(*) AS total FROM estabelecimento WHERE {where}"
    for name, _, where in _FILTERS))
def optional_filters(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    counts = [
        aggregates.count_establishments(estab, **given).select(F.lit(name).alias("filtro"), "total")
        for name, given, _ in _FILTERS
    ]
    return reduce(DataFrame.unionByName, counts)


@query("e3_active_by_place_activity", _sql("estabelecimento") + """
SELECT uf, municipio_cod, cnae_fiscal_principal, count(*) AS qtd FROM estabelecimento
WHERE situacao_cadastral = 2 GROUP BY ALL""")
def active_by_place(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return aggregates.mart_active_by_place_activity(estab)


@query("c10_active_only", _sql("estabelecimento") + """
SELECT uf, count(*) AS ativas FROM estabelecimento WHERE situacao_cadastral = 2 GROUP BY uf""")
def active_only(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return aggregates.active(estab).groupBy("uf").agg(F.count(F.lit(1)).alias("ativas"))


@query("e4_regime_distribution", _sql("regime_tributario") + """
SELECT forma_de_tributacao, count(*) AS registros, count(DISTINCT cnpj_basico) AS empresas_distintas
FROM regime_tributario GROUP BY 1 ORDER BY registros DESC""")
def regime_distribution(spark, sf):
    return aggregates.regime_distribution(star.typed(spark, sf, "regime_tributario")["regime_tributario"])


@query("c5_regime_distribution_year", _sql("regime_tributario") + """
SELECT forma_de_tributacao, count(*) AS registros, count(DISTINCT cnpj_basico) AS empresas_distintas
FROM regime_tributario WHERE ano = 1998 GROUP BY 1""")
def regime_distribution_year(spark, sf):
    regime = star.typed(spark, sf, "regime_tributario")["regime_tributario"]
    return aggregates.regime_distribution(regime, "1998")


@query("g2_forms_by_records", _sql("regime_tributario") + """
SELECT row_number() OVER (ORDER BY registros DESC, forma_de_tributacao) AS posicao,
       forma_de_tributacao, registros
FROM (SELECT forma_de_tributacao, count(*) AS registros FROM regime_tributario GROUP BY 1)""")
def forms_by_records(spark, sf):
    ranked = regime_distribution(spark, sf).select("forma_de_tributacao", "registros")
    return dedup.with_dense_id(
        ranked, [F.desc("registros"), F.col("forma_de_tributacao")], "posicao"
    )


_STATES_SQL = _sql("regime_tributario", "estabelecimento") + """,
 r AS (SELECT r.*, e.uf FROM regime_tributario r LEFT JOIN (SELECT cnpj, min(uf) AS uf FROM estabelecimento GROUP BY 1) e USING (cnpj))
"""


@query("e4_sketch_distribution", _STATES_SQL + """
SELECT 'forma' AS conta, forma_de_tributacao AS chave, count(*) AS registros, count(DISTINCT cnpj_basico) AS empresas_distintas FROM r GROUP BY 2
UNION ALL SELECT 'ano', CAST(ano AS STRING), count(*), count(DISTINCT cnpj_basico) FROM r WHERE forma_de_tributacao = 'LUCRO REAL' GROUP BY 2
UNION ALL SELECT 'uf', uf, count(*), count(DISTINCT cnpj_basico) FROM r WHERE ano = 1997 GROUP BY 2
UNION ALL SELECT 'todas', NULL, count(*), count(DISTINCT cnpj_basico) FROM r
UNION ALL SELECT 'ambas', NULL, NULL, count(*) FROM (
  SELECT DISTINCT cnpj_basico FROM r WHERE ano = 1996 INTERSECT SELECT DISTINCT cnpj_basico FROM r WHERE ano = 1997)""")
def sketch_distribution(spark, sf):
    """Roll-ups of the regimes from the published sets of companies."""
    root = work_path(spark, "e4")
    t = star.typed(spark, sf, "regime_tributario", "estabelecimento")
    publish.commit(spark, root, sketches.write_sketches(root, t["regime_tributario"], t["estabelecimento"]))
    t = publish.tables(spark, root)
    key = lambda df, name, chave: df.select(
        F.lit(name).alias("conta"), F.col(chave).cast("string").alias("chave") if chave else F.lit(None).cast("string").alias("chave"),
        "registros", "empresas_distintas")
    both = sketches.in_common(t, {"ano": 1996}, {"ano": "1997"}).select(
        F.lit(None).cast("long").alias("registros"), F.col("ambas").alias("empresas_distintas"))
    return reduce(DataFrame.unionByName, [
        key(sketches.distribution(t), "forma", "forma_de_tributacao"), key(sketches.distribution(t, ["ano"], forma="LUCRO REAL"), "ano", "ano"),
        key(sketches.distribution(t, ["uf"], ano="1997"), "uf", "uf"), key(sketches.distribution(t, []), "todas", None), key(both, "ambas", None)])


@query("e5_regime_summary", _sql("regime_tributario") + """
SELECT count(*) AS linhas, count(DISTINCT cnpj_basico) AS empresas, min(ano) AS ano_min,
       max(ano) AS ano_max FROM regime_tributario""")
def regime_summary(spark, sf):
    return aggregates.regime_summary(star.typed(spark, sf, "regime_tributario")["regime_tributario"])


@query("e6_distinct_regimes", _sql("regime_tributario") + """
SELECT DISTINCT cnpj_basico, ano, forma_de_tributacao FROM regime_tributario""")
def distinct_regimes(spark, sf):
    regime = star.typed(spark, sf, "regime_tributario")["regime_tributario"]
    return regime.select("cnpj_basico", "ano", "forma_de_tributacao").distinct()


@query("e7_distinct_companies", _sql("estabelecimento") + "SELECT DISTINCT cnpj_basico FROM estabelecimento")
def distinct_companies(spark, sf):
    return star.typed(spark, sf, "estabelecimento")["estabelecimento"].select("cnpj_basico").distinct()


_FACTS = ("empresa", "estabelecimento", "socio", "simples", "regime_tributario")


@query("h1_load_audit", _sql(*_FACTS) + " UNION ALL ".join(
    f"SELECT '{t}' AS t, count(*) AS count FROM {t}" for t in _FACTS))
def load_audit(spark, sf):
    return aggregates.load_audit(star.typed(spark, sf, *_FACTS))


# --- joins -------------------------------------------------------------------------------

@query("d1_decode_nature", _sql("empresa", "dim_natureza_juridica") + """
SELECT cnpj_basico, razao_social, descricao AS natureza_juridica
FROM empresa LEFT JOIN dim_natureza_juridica ON codigo = natureza_juridica_cod""")
def decode_nature(spark, sf):
    t = star.typed(spark, sf, "empresa", "dim_natureza_juridica")
    named = lookup.decode(t["empresa"], t["dim_natureza_juridica"], "natureza_juridica_cod",
                          "natureza_juridica")
    return named.select("cnpj_basico", "razao_social", "natureza_juridica")


@query("a7_domain_decode", _sql("socio", "dim_faixa_etaria", "dim_identificador_socio") + """
SELECT f.descricao AS faixa_etaria, i.descricao AS tipo, count(*) AS socios
FROM socio LEFT JOIN dim_faixa_etaria f ON f.codigo = faixa_etaria_cod
LEFT JOIN dim_identificador_socio i ON i.codigo = identificador_socio GROUP BY ALL""")
def domain_decode(spark, sf):
    t = star.typed(spark, sf, "socio", "dim_faixa_etaria", "dim_identificador_socio")
    rows = lookup.decode(t["socio"], t["dim_faixa_etaria"], "faixa_etaria_cod", "faixa_etaria")
    rows = lookup.decode(rows, t["dim_identificador_socio"], "identificador_socio", "tipo")
    return rows.groupBy("faixa_etaria", "tipo").agg(F.count(F.lit(1)).alias("socios"))


@query("d2_branch_company", _sql("estabelecimento", "empresa") + """
SELECT cnpj, razao_social, CAST(capital_social AS DOUBLE) AS capital_social
FROM estabelecimento LEFT JOIN empresa USING (cnpj_basico)""")
def branch_company(spark, sf):
    t = star.typed(spark, sf, *_BRANCH_TABLES)
    return _doubles(branches.branch_view(t).select("cnpj", "razao_social", "capital_social"),
                    "capital_social")


_BRANCH_TABLES = (
    "estabelecimento", "empresa", "dim_matriz_filial", "dim_situacao_cadastral", "dim_cnae",
    "dim_municipio", "dim_natureza_juridica",
)
_BRANCH_TEXTS = {
    "matriz_filial": _text("dim_matriz_filial", "b.matriz_filial"),
    "situacao": _text("dim_situacao_cadastral", "b.situacao_cadastral"),
    "cnae_principal": _text("dim_cnae", "b.cnae_fiscal_principal"),
    "municipio": _text("dim_municipio", "b.municipio_cod", "nome"),
}
_COMPANY_FIELDS = {
    "razao_social": "empresa.razao_social",
    "capital_social": "CAST(empresa.capital_social AS DOUBLE)",
    "natureza_juridica": _text("dim_natureza_juridica", "empresa.natureza_juridica_cod"),
}
_BRANCH_SQL = _sql(*_BRANCH_TABLES) + "SELECT " + ", ".join(
    f"{(_BRANCH_TEXTS | _COMPANY_FIELDS).get(c, 'b.' + c)} AS {c}" for c in branches.COLUMNS
) + " FROM estabelecimento b LEFT JOIN empresa USING (cnpj_basico) "


@query("d4_branch_view", _BRANCH_SQL)
def branch_view(spark, sf):
    return _doubles(branches.branch_view(star.typed(spark, sf, *_BRANCH_TABLES)), "capital_social")


@query("d4_branch_view_state", _BRANCH_SQL + "WHERE b.uf = 'SP'")
def branch_view_state(spark, sf):
    rows = branches.branch_view(star.typed(spark, sf, *_BRANCH_TABLES), uf="SP")
    return _doubles(rows, "capital_social")


_ONE_BRANCH_SQL = "(SELECT min(cnpj) FROM estabelecimento)"


def _one_branch(spark, sf) -> str:
    """Some branch to ask for."""
    return star.typed(spark, sf, "estabelecimento")["estabelecimento"].agg(F.min("cnpj")).first()[0]


@query("c6_branch_by_id", _BRANCH_SQL + f"WHERE b.cnpj = {_ONE_BRANCH_SQL}")
def branch_by_id(spark, sf):
    rows = branches.branch_view(star.typed(spark, sf, *_BRANCH_TABLES), cnpj=_one_branch(spark, sf))
    return _doubles(rows, "capital_social")


_MOVED_SQL = _BRANCH_SQL.replace("FROM estabelecimento b", """FROM (
  SELECT * FROM (SELECT * FROM estabelecimento UNION ALL
    SELECT * REPLACE ('AC' AS uf, 'antes' AS nome_fantasia) FROM estabelecimento WHERE cnpj LIKE '%7' UNION ALL
    SELECT * REPLACE ('TO' AS uf, 'depois' AS nome_fantasia) FROM estabelecimento WHERE cnpj LIKE '%3')
  QUALIFY row_number() OVER (PARTITION BY cnpj ORDER BY uf, nome_fantasia NULLS FIRST, data_inicio_atividade, cep) = 1) b""")


@query("g7_first_branch_row", _MOVED_SQL)
def first_branch_row(spark, sf):
    """Every branch id's first row by state, where ids occur in two states, through the branch view."""
    t = star.typed(spark, sf, *_BRANCH_TABLES)
    own = t["estabelecimento"]
    moved = [own.filter(F.col("cnpj").endswith(end)).withColumns({"uf": F.lit(uf), "nome_fantasia": F.lit(name)})
             for end, uf, name in (("7", "AC", "antes"), ("3", "TO", "depois"))]
    t["estabelecimento"] = own.unionByName(moved[0]).unionByName(moved[1])
    return _doubles(branches.branch_view(t, first=["nome_fantasia", "data_inicio_atividade", "cep"]), "capital_social")


_NETWORK_TABLES = ("socio", "empresa", "dim_qualificacao")
_LINK_ORDER = "cnpj_basico, nome_socio, qualificacao_socio_cod"
_LINKS_SQL = _sql(*_NETWORK_TABLES) + f"""
SELECT {{columns}} cnpj_basico, nome_socio,
       (SELECT razao_social FROM empresa WHERE empresa.cnpj_basico = socio.cnpj_basico) AS razao_social,
       {_text('dim_qualificacao', 'qualificacao_socio_cod')} AS qualificacao
FROM socio """
_ONE_PARTNER = "***000007**"
_ONE_PARTNER_SQL = _LINKS_SQL.replace("{columns}", "") + f"""
WHERE cnpj_cpf_socio = '{_ONE_PARTNER}' ORDER BY {_LINK_ORDER} LIMIT """


@query("d5_partner_network", _ONE_PARTNER_SQL + "50")
def partner_network(spark, sf):
    limit = ids.clamp_limit(None, network.DEFAULT_LIMIT, network.MAX_LIMIT)
    return network.partner_network(star.typed(spark, sf, *_NETWORK_TABLES), _ONE_PARTNER, limit)


@query("g5_partner_network_limit", _ONE_PARTNER_SQL + "500")
def partner_network_limit(spark, sf):
    limit = ids.clamp_limit("99999", network.DEFAULT_LIMIT, network.MAX_LIMIT)
    return network.partner_network(star.typed(spark, sf, *_NETWORK_TABLES), _ONE_PARTNER, limit)


@query("d3_partner_company", _LINKS_SQL.replace("{columns}", "cnpj_cpf_socio,") + "WHERE cnpj_cpf_socio IS NOT NULL")
def partner_company(spark, sf):
    t = star.typed(spark, sf, *_NETWORK_TABLES)
    return network.partner_network_batch(t, t["socio"].select("cnpj_cpf_socio"))


@query("d3_partner_company_top", _LINKS_SQL.replace("{columns}", "cnpj_cpf_socio,") + f"""
QUALIFY cnpj_cpf_socio IS NOT NULL AND row_number() OVER (PARTITION BY cnpj_cpf_socio ORDER BY {_LINK_ORDER}) <= 50""")
def partner_company_top(spark, sf):
    t = star.typed(spark, sf, *_NETWORK_TABLES)
    return network.partner_network_batch(t, t["socio"].select("cnpj_cpf_socio"), 50)


_DOCUMENT_TABLES = (
    "empresa", "estabelecimento", "socio", "simples", "regime_tributario", "dim_natureza_juridica",
    "dim_porte", "dim_matriz_filial", "dim_situacao_cadastral", "dim_cnae", "dim_municipio",
    "dim_qualificacao",
)


def _struct(fields, values: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{f}': {values.get(f, 'b.' + f)}" for f in fields) + "}"


def _array(table: str, fields, order: str, values: dict[str, str]) -> str:
    return (f"SELECT cnpj_basico, list({_struct(fields, values)} ORDER BY {order}) AS children "
            f"FROM {table} b GROUP BY cnpj_basico")


def _document_sql(highlight: str = "false") -> str:
    """``WITH`` clause whose ``documents`` holds a nested row per company."""
    role = _text("dim_qualificacao", "b.qualificacao_socio_cod")
    nested = {
        "estabelecimentos": _array(
            "estabelecimento", documents.BRANCH_FIELDS,
            "b.matriz_filial NULLS LAST, b.cnpj", _BRANCH_TEXTS | {"consultado": highlight}),
        "qsa": _array(
            "socio", documents.PARTNER_FIELDS,
            f"b.nome_socio NULLS LAST, b.cnpj_cpf_socio NULLS FIRST, {role} NULLS FIRST, "
            "b.data_entrada_sociedade NULLS FIRST", {"qualificacao": role}),
        "regime_tributario": _array(
            "regime_tributario", documents.REGIME_FIELDS,
            "b.ano DESC, b.cnpj, b.forma_de_tributacao, b.qtd_escrituracoes", {}),
    }
    arrays = ", ".join(f"array_{n} AS ({sql})" for n, sql in nested.items())
    columns = ", ".join(f"coalesce(array_{n}.children, []) AS {n}" for n in nested)
    joins = " ".join(f"LEFT JOIN array_{n} USING (cnpj_basico)" for n in nested)
    flags = _struct(documents.SIMPLES_FIELDS, {})
    return _sql(*_DOCUMENT_TABLES) + f""", {arrays}, documents AS (
        SELECT cnpj_basico, {', '.join(f'{v} AS {c}' for c, v in _COMPANY_FIELDS.items())},
               {_text('dim_porte', 'empresa.porte_cod')} AS porte,
               CASE WHEN b.data_opcao_simples IS NOT NULL THEN {flags} END AS simples, {columns}
        FROM empresa LEFT JOIN simples b USING (cnpj_basico) {joins})
    """


def _as_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON texts, for comparison."""
    options = {"ignoreNullFields": "false"}
    nested = ("simples", "estabelecimentos", "qsa", "regime_tributario")
    return df.withColumns({c: F.to_json(c, options) for c in nested})


_JSON_COLUMNS = """to_json(estabelecimentos)::VARCHAR AS estabelecimentos, to_json(qsa)::VARCHAR AS qsa,
       to_json(regime_tributario)::VARCHAR AS regime_tributario, to_json(simples)::VARCHAR AS simples"""


@query("d6_company_documents", _document_sql() + f"""
SELECT cnpj_basico, razao_social, natureza_juridica, capital_social, porte, {_JSON_COLUMNS}
FROM documents""")
def company_documents(spark, sf):
    docs = documents.company_documents(star.typed(spark, sf, *_DOCUMENT_TABLES))
    return _doubles(_as_json(docs.drop("page", "pages", "cnpj_consultado")), "capital_social")


@query("g3_branch_order", _sql("estabelecimento") + """
SELECT cnpj_basico, string_agg(cnpj, ' ' ORDER BY matriz_filial NULLS LAST, cnpj) AS ordem
FROM estabelecimento WHERE cnpj_basico IN (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') FROM customer)
GROUP BY 1""")
def branch_order(spark, sf):
    docs = documents.company_documents(star.typed(spark, sf, *_DOCUMENT_TABLES))
    with_branches = docs.filter(F.size("estabelecimentos") > 0)
    return with_branches.select("cnpj_basico", F.array_join("estabelecimentos.cnpj", " ").alias("ordem"))


@query("g4_regime_order", _sql("regime_tributario") + """
SELECT cnpj_basico, string_agg(CAST(ano AS STRING) || '/' || cnpj, ' ' ORDER BY ano DESC, cnpj) AS ordem
FROM regime_tributario WHERE cnpj_basico IN (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') FROM customer)
GROUP BY 1""")
def regime_order(spark, sf):
    docs = documents.company_documents(star.typed(spark, sf, *_DOCUMENT_TABLES))
    entries = F.transform("regime_tributario", lambda r: F.concat(r["ano"].cast("string"), F.lit("/"), r["cnpj"]))
    return docs.filter(F.size("regime_tributario") > 0).select(
        "cnpj_basico", F.array_join(entries, " ").alias("ordem")
    )


@query("c11_highlighted_branch", _document_sql(f"b.cnpj = {_ONE_BRANCH_SQL}") + f"""
SELECT cnpj_basico, {_ONE_BRANCH_SQL} AS cnpj_consultado, razao_social, {_JSON_COLUMNS}
FROM documents WHERE cnpj_basico = left({_ONE_BRANCH_SQL}, 8)""")
def highlighted_branch(spark, sf):
    docs = documents.company_document(star.typed(spark, sf, *_DOCUMENT_TABLES), _one_branch(spark, sf))
    return _as_json(docs).select(
        "cnpj_basico", "cnpj_consultado", "razao_social", "estabelecimentos", "qsa",
        "regime_tributario", "simples",
    )


@query("b8_json_documents", _document_sql() + """
SELECT to_json({'cnpj_basico': cnpj_basico, 'razao_social': razao_social,
                'natureza_juridica': natureza_juridica, 'porte': porte,
                'estabelecimentos': estabelecimentos, 'qsa': qsa, 'simples': simples,
                'regime_tributario': regime_tributario})::VARCHAR AS document FROM documents""")
def json_documents(spark, sf):
    docs = documents.company_documents(star.typed(spark, sf, *_DOCUMENT_TABLES))
    return documents.to_documents(docs.select(
        "cnpj_basico", "razao_social", "natureza_juridica", "porte", "estabelecimentos", "qsa",
        "simples", "regime_tributario",
    ))


# Requested ids: every order as a branch id, every customer as a company id, and ids of
# suppliers and parts that are unknown or of a wrong length.
_REQUEST_SQL = f"""
SELECT {star._id('o_custkey')} || {star._id('o_orderkey % 1000000', 6)} AS registry_id FROM {{orders}}
UNION ALL SELECT {star._id('c_custkey')} FROM {{customer}}
UNION ALL SELECT '9' || {star._id('s_suppkey', 7)} FROM {{supplier}}
UNION ALL SELECT {star._id('p_partkey', 10)} FROM {{part}}"""
_REQUEST_CTE = "requests AS (" + _REQUEST_SQL.format(
    **{n: n for n in ("orders", "customer", "supplier", "part")}) + ")"


def _requests(spark, sf):
    names = ("orders", "customer", "supplier", "part")
    return spark.sql(_REQUEST_SQL, **{n: star.source(spark, sf, n) for n in names})


@query("c7_id_shapes", f"WITH {_REQUEST_CTE}" + """
SELECT CASE length(registry_id) WHEN 8 THEN registry_id WHEN 14 THEN substring(registry_id, 1, 8) END
         AS cnpj_basico, CASE length(registry_id) WHEN 14 THEN registry_id END AS consultado,
       length(registry_id) IN (8, 14) AS valid, registry_id FROM requests""")
def id_shapes(spark, sf):
    shaped = _requests(spark, sf).withColumn("_id", ids.split_registry_id(F.col("registry_id")))
    return shaped.select("registry_id", "_id.*")


_ANSWERS_SQL = f"WITH {_REQUEST_CTE}, {_sql('empresa')[5:]}" + """, answers AS (
  SELECT registry_id, CASE WHEN length(registry_id) IN (8, 14) THEN substring(registry_id, 1, 8) END AS cnpj_basico,
         CASE length(registry_id) WHEN 14 THEN registry_id END AS cnpj_consultado,
         length(registry_id) IN (8, 14) AS valid,
         length(registry_id) IN (8, 14) AND substring(registry_id, 1, 8) IN (SELECT cnpj_basico FROM empresa) AS found
  FROM requests)
"""


def _enriched(spark, sf):
    return documents.enrich(_requests(spark, sf), star.typed(spark, sf, *_DOCUMENT_TABLES))


@query("d9_enrich_ids", f"WITH {_REQUEST_CTE}, {_document_sql('b.cnpj IN (SELECT registry_id FROM requests)')[5:]}" + f"""
SELECT cnpj_basico, razao_social, natureza_juridica, capital_social, porte, {_JSON_COLUMNS}
FROM documents WHERE cnpj_basico IN (SELECT substring(registry_id, 1, 8) FROM requests
                                     WHERE length(registry_id) IN (8, 14))""")
def enrich_ids(spark, sf):
    return _doubles(_as_json(_enriched(spark, sf)[1].drop("page", "pages")), "capital_social")


@query("d9_enrich_requests", _ANSWERS_SQL + "SELECT * FROM answers")
def enrich_requests(spark, sf):
    return _enriched(spark, sf)[0]


@query("c12_not_found", _ANSWERS_SQL + """
SELECT registry_id, valid, found, CASE WHEN NOT valid THEN 'bad id' WHEN NOT found THEN 'unknown' ELSE 'known' END AS estado
FROM answers""")
def not_found(spark, sf):
    state = F.when(~F.col("valid"), "bad id").when(~F.col("found"), "unknown").otherwise("known")
    return _enriched(spark, sf)[0].select("registry_id", "valid", "found", state.alias("estado"))


@query("d8_orphan_codes", _sql("estabelecimento", "dim_cnae") + """
SELECT cnae_fiscal_principal, count(*) AS linhas FROM estabelecimento
WHERE cnae_fiscal_principal NOT IN (SELECT codigo FROM dim_cnae) GROUP BY 1""")
def orphan_codes(spark, sf):
    t = star.typed(spark, sf, "estabelecimento", "dim_cnae")
    return quality.orphan_codes(t["estabelecimento"], t["dim_cnae"], "cnae_fiscal_principal")


# --- de-duplication, keys, ids -----------------------------------------------------------

_LINE_COLUMNS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate")


@query("b3_keep_first", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_COLUMNS)}) = 1""")
def keep_first(spark, sf):
    first = dedup.keep_first(star.source(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_COLUMNS)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("b4_dense_ids", """
SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS id, c_custkey FROM customer""")
def dense_ids(spark, sf):
    customers = star.source(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return dedup.with_dense_id(customers, ["c_acctbal", "c_custkey"]).select("id", "c_custkey")


@query("b4_unique_ids", "SELECT count(*) AS linhas, count(*) AS ids FROM lineitem")
def unique_ids(spark, sf):
    lines = dedup.with_surrogate_id(star.source(spark, sf, "lineitem").select("l_orderkey"))
    return lines.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct("id").alias("ids"))


@query("b7_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(star.source(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_CHECKED = ("cnpj", "matriz_filial", "nome_fantasia", "uf", "pais_cod")


@query("b9_null_counts", _sql("estabelecimento") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM estabelecimento"
    for c in _CHECKED))
def null_counts(spark, sf):
    return quality.null_counts(star.typed(spark, sf, "estabelecimento")["estabelecimento"], _CHECKED)


@query("b9_quarantine", _sql("estabelecimento") + """
SELECT matriz_filial IS NOT NULL AND nome_fantasia IS NOT NULL AS aceita, count(*) AS linhas
FROM estabelecimento GROUP BY 1""")
def quarantine(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    kept, held = quality.split_not_null(estab, ["matriz_filial", "nome_fantasia"])
    both = kept.select(F.lit(True).alias("aceita")).unionByName(held.select(F.lit(False).alias("aceita")))
    return both.groupBy("aceita").agg(F.count(F.lit(1)).alias("linhas"))


# --- typed transforms --------------------------------------------------------------------

def _value_sql(kind: str, sources: tuple[str, ...]) -> str:
    """What a kind of column means, in DuckDB's terms."""
    c = sources[0]
    digits = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return {
        "as is": c,
        "text": f"nullif({c}, '')",
        "smallint": f"CAST(nullif({c}, '') AS SMALLINT)",
        "int": f"CAST(nullif({c}, '') AS INT)",
        "money": f"CAST(CAST(nullif(replace({c}, ',', '.'), '') AS DECIMAL(18, 2)) AS DOUBLE)",
        "date": f"CAST(strptime(nullif(ltrim(trim({c}), '0'), ''), '%Y%m%d') AS DATE)",
        "flag": f"CASE WHEN {c} ILIKE 's' THEN true WHEN {c} ILIKE 'n' THEN false END",
        "state": f"CASE WHEN trim(coalesce({c}, '')) = '' THEN '??' ELSE trim({c}) END",
        "phone": f"nullif(trim({' || '.join(sources)}), '')",
        "joined": " || ".join(sources),
        "digits": digits,
        "base of digits": f"left({digits}, 8)",
        "partnership": f"CASE WHEN {c} NOT IN ('', '0') THEN left({c}, 14) END",
    }[kind]


def _typed_sql(table: str) -> str:
    """Typed rows of a feed, one per key where the table has one."""
    feed = FACT_FEEDS[table]
    values = ", ".join(f"{_value_sql(kind, sources)} AS {name}" for name, kind, sources in TYPED_COLUMNS[table])
    if table == "regime_tributario":
        return (f"SELECT DISTINCT {values} FROM stg_{feed} "
                f"WHERE length({_value_sql('digits', ('cnpj',))}) = 14 AND ano <> '' AND forma_de_tributacao <> ''")
    rows = f"SELECT {values}, {', '.join(ARRIVAL)} FROM stg_{feed} WHERE {_IS_BASE}"
    first = ""
    if table in FACT_KEYS:
        keys = ", ".join(FACT_KEYS[table])
        first = f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {', '.join(ARRIVAL)}) = 1"
    return f"SELECT * EXCLUDE ({', '.join(ARRIVAL)}) FROM ({rows}) {first}"


_IS_BASE = "regexp_full_match(cnpj_basico, '[0-9]{8}')"


@query("c1_empresa", _sql("stg_empresas") + _typed_sql("empresa"))
def typed_empresa(spark, sf):
    rows = transform.transform_empresa(star.staging(spark, sf, "empresas")["empresas"])
    return _doubles(rows, "capital_social")


@query("c1_estabelecimento", _sql("stg_estabelecimentos") + _typed_sql("estabelecimento"))
def typed_estabelecimento(spark, sf):
    return transform.transform_estabelecimento(star.staging(spark, sf, "estabelecimentos")["estabelecimentos"])


@query("c1_socio", _sql("stg_socios") + _typed_sql("socio"))
def typed_socio(spark, sf):
    return transform.transform_socio(star.staging(spark, sf, "socios")["socios"])


@query("c1_simples", _sql("stg_simples") + _typed_sql("simples"))
def typed_simples(spark, sf):
    return transform.transform_simples(star.staging(spark, sf, "simples")["simples"])


_REGIME_SQL = _sql("stg_regime") + f", regime AS ({_typed_sql('regime_tributario')}) "


@query("c1_regime", _REGIME_SQL + "SELECT * FROM regime")
def typed_regime(spark, sf):
    return transform.transform_regime(star.staging(spark, sf, "regime")["regime"])


def _lookup_sql(feed: str, kind: str) -> str:
    return _sql(f"stg_{feed}") + f"""
    SELECT CAST(codigo AS {kind}) AS codigo, descricao FROM stg_{feed}
    WHERE regexp_full_match(codigo, '[0-9]+')
    QUALIFY row_number() OVER (PARTITION BY CAST(codigo AS {kind}) ORDER BY {', '.join(ARRIVAL)}) = 1"""


@query("c1_lookup_nature", _lookup_sql("naturezas", "SMALLINT"))
def typed_nature(spark, sf):
    return transform.transform_lookup(star.staging(spark, sf, "naturezas")["naturezas"], "dim_natureza_juridica")


@query("c1_lookup_activity", _lookup_sql("cnaes", "INT"))
def typed_activity(spark, sf):
    return transform.transform_lookup(star.staging(spark, sf, "cnaes")["cnaes"], "dim_cnae")


@query("i12_explode_codes", _sql("stg_estabelecimentos") + f"""
SELECT DISTINCT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj,
       unnest([CAST(c AS INT) FOR c IN regexp_split_to_array(cnae_secundaria, ' *, *')
               IF regexp_full_match(c, '[0-9]+')]) AS cnae_cod
FROM stg_estabelecimentos WHERE {_IS_BASE}""")
def explode_codes(spark, sf):
    return transform.explode_codes(star.staging(spark, sf, "estabelecimentos")["estabelecimentos"])


@query("c2_base_id_shape", _sql("stg_empresas") + f"""
SELECT {_IS_BASE} AS valido, count(*) AS linhas FROM stg_empresas GROUP BY 1""")
def base_id_shape(spark, sf):
    rows = star.staging(spark, sf, "empresas")["empresas"]
    return rows.groupBy(clean.is_base_id(F.col("cnpj_basico")).alias("valido")).agg(
        F.count(F.lit(1)).alias("linhas"))


@query("c3_code_shape", _sql("stg_cnaes") + """
SELECT codigo, descricao FROM stg_cnaes WHERE regexp_full_match(codigo, '[0-9]+')""")
def code_shape(spark, sf):
    rows = star.staging(spark, sf, "cnaes")["cnaes"].select("codigo", "descricao")
    return rows.filter(clean.is_code(F.col("codigo")))


@query("c8_full_id_length", _sql("stg_regime") + """
SELECT length(regexp_replace(cnpj, '[^0-9]', '', 'g')) = 14 AS completo, count(*) AS linhas
FROM stg_regime GROUP BY 1""")
def full_id_length(spark, sf):
    rows = star.staging(spark, sf, "regime")["regime"]
    full = clean.has_full_id(clean.digits_only(F.col("cnpj"))).alias("completo")
    return rows.groupBy(full).agg(F.count(F.lit(1)).alias("linhas"))


@query("c9_not_blank", _sql("stg_regime") + """
SELECT nullif(ano, '') IS NOT NULL AS preenchido, count(*) AS linhas FROM stg_regime GROUP BY 1""")
def not_blank(spark, sf):
    rows = star.staging(spark, sf, "regime")["regime"]
    return rows.groupBy(clean.not_blank(F.col("ano")).alias("preenchido")).agg(
        F.count(F.lit(1)).alias("linhas"))


# --- scalar expressions ------------------------------------------------------------------

# Orders with dates and amounts that do not parse among those that do.
_BAD_SQL = f"""
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '00000000'
       WHEN 3 THEN '20230230' WHEN 4 THEN ' ' ELSE {star._day('o_orderdate')} END AS dia,
       CASE WHEN o_orderkey % 8 = 0 THEN '1.234,56' WHEN o_orderkey % 8 = 1 THEN ''
            ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING), '.', ',') END AS valor
FROM {{orders}}"""
_BAD_CTE = "WITH bad AS (" + _BAD_SQL.format(orders="orders") + ")\n"
_BAD_DATE = """CASE WHEN trim(dia) IN ('', '0', '00000000') THEN NULL
       ELSE CAST(try_strptime(trim(dia), '%Y%m%d') AS DATE) END"""


def _bad(spark, sf):
    return spark.sql(_BAD_SQL, orders=star.source(spark, sf, "orders"))


@query("i4_parse_date", _BAD_CTE + f"SELECT o_orderkey, {_BAD_DATE} AS dia FROM bad")
def parse_date(spark, sf):
    return _bad(spark, sf).select("o_orderkey", clean.parse_date(F.col("dia"), strict=False).alias("dia"))


@query("i2_decimal_comma", _BAD_CTE + """
SELECT o_orderkey, CAST(TRY_CAST(nullif(replace(valor, ',', '.'), '') AS DECIMAL(18, 2)) AS DOUBLE) AS valor FROM bad""")
def decimal_comma(spark, sf):
    value = clean.to_money(F.col("valor"), strict=False).cast("double")
    return _bad(spark, sf).select("o_orderkey", value.alias("valor"))


@query("i3_rejected_values", _sql("stg_empresas") + f"""
SELECT cnpj_basico, 'porte_cod' AS coluna FROM (SELECT * REPLACE (porte || 'x' AS porte) FROM stg_empresas)
WHERE {_IS_BASE} AND TRY_CAST(nullif(porte, '') AS SMALLINT) IS NULL""")
def rejected_values(spark, sf):
    rows = star.staging(spark, sf, "empresas")["empresas"].withColumn("porte", F.concat("porte", F.lit("x")))
    found = transform.rejects(rows, "empresa")
    return found.select("cnpj_basico", F.explode("_rejects").alias("coluna"))


@query("i5_text_scalars", """
SELECT c_custkey, nullif(seg, '') AS sem_vazio, trim('  ' || c_name || ' ') AS aparado,
       substring(c_name, 1, 8) AS inicio, regexp_replace(c_name, '[^0-9]', '', 'g') AS digitos,
       length(c_name) AS tamanho, c_name || seg AS junto,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE seg END || c_name AS junto_nulo,
       coalesce(nullif(trim(CASE WHEN seg = '' THEN '  ' ELSE seg END), ''), '??') AS estado
FROM (SELECT *, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS seg FROM customer)""")
def text_scalars(spark, sf):
    seg = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment"))
    rows = star.source(spark, sf, "customer").withColumn("seg", seg)
    name = F.col("c_name")
    return rows.select(
        "c_custkey", clean.blank_to_null(F.col("seg")).alias("sem_vazio"),
        clean.trim_to_null(F.concat(F.lit("  "), name, F.lit(" "))).alias("aparado"),
        clean.base_id(name).alias("inicio"), clean.digits_only(name).alias("digitos"),
        F.length(name).cast("long").alias("tamanho"),
        clean.phone(name, F.col("seg")).alias("junto"),
        clean.phone(F.when(F.col("c_custkey") % 3 != 0, F.col("seg")), name).alias("junto_nulo"),
        clean.state_or_unknown(F.when(F.col("seg") == "", "  ").otherwise(F.col("seg"))).alias("estado"),
    )


@query("i13_flags", _sql("stg_simples") + f"""
SELECT {_value_sql('flag', ('opcao_simples',))} AS simples, {_value_sql('flag', ('opcao_mei',))} AS mei,
       count(*) AS linhas FROM stg_simples GROUP BY ALL""")
def flags(spark, sf):
    rows = star.staging(spark, sf, "simples")["simples"]
    return rows.groupBy(
        clean.yes_no(F.col("opcao_simples")).alias("simples"), clean.yes_no(F.col("opcao_mei")).alias("mei")
    ).agg(F.count(F.lit(1)).alias("linhas"))


@query("i14_partnership_ids", _sql("stg_regime") + f"""
SELECT {_value_sql('partnership', ('cnpj_da_scp',))} AS cortado,
       left(regexp_replace({_value_sql('partnership', ('cnpj_da_scp',)).replace('14', '99')}, '[^0-9]', '', 'g'), 14)
         AS digitos, count(*) AS linhas FROM stg_regime GROUP BY ALL""")
def partnership_ids(spark, sf):
    rows, c = star.staging(spark, sf, "regime")["regime"], F.col("cnpj_da_scp")
    return rows.groupBy(
        clean.partnership_id(c).alias("cortado"), clean.partnership_id(c, digits=True).alias("digitos")
    ).agg(F.count(F.lit(1)).alias("linhas"))


@query("i18_month_labels", """
SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS linhas FROM orders GROUP BY 1""")
def month_labels(spark, sf):
    path = F.concat(F.lit("/feeds/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("/Empresas0.zip"))
    return star.source(spark, sf, "orders").groupBy(clean.month_label(path).alias("mes")).agg(
        F.count(F.lit(1)).alias("linhas"))


@query("i18_dated_parent_folder", """
SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS linhas FROM orders GROUP BY 1""")
def month_labels_below_dated_parent(spark, sf):
    path = F.concat(F.lit("/backfill/2020-01/feeds/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("/Empresas0.zip"))
    return star.source(spark, sf, "orders").groupBy(clean.month_label(path).alias("mes")).agg(
        F.count(F.lit(1)).alias("linhas"))


@query("k1_sql_function", _BAD_CTE + f"SELECT {_BAD_DATE} AS dia, count(*) AS linhas FROM bad GROUP BY 1")
def sql_function(spark, sf):
    from regiscope.functions.sql import register_functions

    register_functions(spark)
    return _bad(spark, sf).groupBy(F.expr("parse_date(dia)").alias("dia")).agg(
        F.count(F.lit(1)).alias("linhas"))


@query("k1_table_functions", _sql("estabelecimento", "regime_tributario", "socio") + f"""
SELECT 'filtros' AS consulta, NULL AS chave, count(*) AS n FROM estabelecimento WHERE uf = 'SP' AND situacao_cadastral = 2
UNION ALL SELECT 'todos', NULL, count(*) FROM estabelecimento
UNION ALL SELECT 'regimes', forma_de_tributacao, count(DISTINCT cnpj_basico) FROM regime_tributario WHERE ano = 1997 GROUP BY 2
UNION ALL SELECT 'rede', cnpj_basico, count(*) FROM socio WHERE cnpj_cpf_socio = '{_ONE_PARTNER}' GROUP BY 2""")
def table_functions(spark, sf):
    """The parameterised questions, asked in SQL."""
    from regiscope.functions.sql import register_queries

    register_queries(spark, star.typed(spark, sf, "estabelecimento", "regime_tributario", "socio", "empresa", "dim_qualificacao"))
    return spark.sql(f"""
        SELECT 'filtros' AS consulta, CAST(NULL AS STRING) AS chave, total AS n FROM contar_estabelecimentos(p_uf => 'SP', p_situacao => 2)
        UNION ALL SELECT 'todos', NULL, total FROM contar_estabelecimentos()
        UNION ALL SELECT 'regimes', forma_de_tributacao, empresas_distintas FROM distribuicao_regimes(1997)
        UNION ALL SELECT 'rede', cnpj_basico, count(*) FROM rede_socio('{_ONE_PARTNER}') GROUP BY cnpj_basico""")


# --- search, series, profiles ------------------------------------------------------------

_TRIGRAM_SQL = """
WITH words AS (SELECT p_partkey, p_name,
         trim(regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS norm FROM part),
grams AS (SELECT p_partkey, p_name, list_distinct(flatten(list_transform(string_split(norm, ' '),
         lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))) AS g
         FROM words),
asked AS (SELECT list_distinct(flatten(list_transform(string_split('QUERY', ' '),
         lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))) AS q),
scored AS (SELECT p_partkey, p_name, len(list_intersect(g, q)) / len(list_distinct(g || q)) AS similaridade
         FROM grams, asked)
SELECT p_partkey, p_name, similaridade FROM scored WHERE similaridade >= 0.3"""


@query("l1_name_similarity", _TRIGRAM_SQL.replace("QUERY", "red rings"))
def name_similarity(spark, sf):
    parts = star.source(spark, sf, "part").select("p_partkey", "p_name")
    return search.name_similarity(parts, "p_name", "Red-Rings", 0.3)


_GRAMS_SQL = """list_distinct(flatten(list_transform(string_split(
         trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '),
         lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"""


@query("l1_similarity_batch", f"""
WITH n AS (SELECT DISTINCT p_name, {_GRAMS_SQL.format('p_name')} AS g FROM part),
 q AS (SELECT DISTINCT query, {_GRAMS_SQL.format('query')} AS w FROM (
       SELECT split_part(p_name, ' ', 2) || ' ' || p_type AS query FROM part)),
 s AS (SELECT p_name, query, len(list_intersect(g, w)) / len(list_distinct(g || w)) AS similaridade FROM n, q)
SELECT p_partkey, p_name, query, similaridade FROM s JOIN part USING (p_name) WHERE similaridade >= 0.3""")
def similarity_batch(spark, sf):
    """Every part's second word and type asked for among all names."""
    parts = star.source(spark, sf, "part")
    queries = parts.select(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_type").alias("query"))
    return search.name_similarity_batch(parts.select("p_partkey", "p_name"), "p_name", queries, threshold=0.3)


@query("l1_name_search", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%'")
def name_search(spark, sf):
    parts = star.source(spark, sf, "part").select("p_partkey", "p_name")
    return search.name_search(parts, "p_name", "Ring")


def _indexed_parts(spark, sf):
    """Parts published with an index of their names, as a load does it for companies."""
    root, keys = work_path(spark, "l1"), ("p_partkey",)
    parts = star.source(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    paths = {"produto": publish.write_version(parts, root, "produto", cluster_by=keys)}
    written = spark.read.parquet(paths["produto"])
    publish.commit(spark, root, paths | name_index.write_index(root, "produto", written, "p_name", keys))
    return name_index.name_index(publish.tables(spark, root), "produto", "p_name", keys)


@query("l1_postings_search", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%'")
def postings_search(spark, sf):
    """The substring search, from the published postings."""
    return name_index.search(_indexed_parts(spark, sf), "Ring").select("p_partkey", "p_name")


@query("l1_postings_similarity", _TRIGRAM_SQL.replace("QUERY", "red rings"))
def postings_similarity(spark, sf):
    return name_index.similar(_indexed_parts(spark, sf), "Red-Rings", 0.3).select("p_partkey", "p_name", "similaridade")


@query("l1_postings_batch", ORACLE["l1_similarity_batch"])
def postings_batch(spark, sf):
    """Every part's second word and type asked for among all names, from the published postings."""
    index = _indexed_parts(spark, sf)
    queries = index.fact.select(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_type").alias("query"))
    return name_index.similar_batch(index, queries, threshold=0.3).select("p_partkey", "p_name", "query", "similaridade")


@query("l1_text_search", "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'eau')")
def text_search(spark, sf):
    found = search.name_search(star.source(spark, sf, "documents"), "text", "EAU")
    return found.select("doc_id", "lang", "source")


_REVERSE_SQL = _sql("stg_estabelecimentos", "estabelecimento") + """, bridge AS (
  SELECT DISTINCT o_custkey, o_orderkey, lpad(CAST(o_custkey AS STRING), 8, '0')
       || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0') AS cnpj, CAST(l_partkey AS INT) AS cnae_cod
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def _bridge(spark, sf):
    lines = star.source(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    orders = star.source(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cnpj = F.concat(
        F.lpad(F.col("o_custkey").cast("string"), 8, "0"),
        F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"),
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(cnpj.alias("cnpj"), F.col("l_partkey").cast("int").alias("cnae_cod")).distinct()


@query("l2_by_activity", _REVERSE_SQL + """
SELECT cnpj, uf, CASE WHEN cnae_fiscal_principal = 17 THEN 'principal' ELSE 'secundaria' END AS origem
FROM estabelecimento WHERE cnae_fiscal_principal = 17
   OR cnpj IN (SELECT cnpj FROM bridge WHERE cnae_cod = 17)""")
def by_activity(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return search.establishments_by_activity(estab, _bridge(spark, sf), 17).select("cnpj", "uf", "origem")


@query("l3_openings_by_month", _sql("estabelecimento") + """
SELECT CAST(date_trunc('month', data_inicio_atividade) AS DATE) AS periodo, count(*) AS aberturas
FROM estabelecimento GROUP BY 1""")
def openings_by_month(spark, sf):
    return aggregates.openings_series(star.typed(spark, sf, "estabelecimento")["estabelecimento"])


@query("l3_events_by_day", "SELECT CAST(ts AS DATE) AS periodo, count(*) AS aberturas FROM events GROUP BY 1")
def events_by_day(spark, sf):
    return aggregates.openings_series(star.source(spark, sf, "events"), "day", start="ts")


@query("l4_active_by_activity", _sql("estabelecimento") + """
SELECT cnae_fiscal_principal, count(*) AS qtd FROM estabelecimento
WHERE situacao_cadastral = 2 GROUP BY 1""")
def active_by_activity(spark, sf):
    return aggregates.active_by_activity(star.typed(spark, sf, "estabelecimento")["estabelecimento"])


@query("l5_by_municipality", _sql("estabelecimento", "dim_municipio") + """
SELECT municipio_cod, nome AS municipio, count(*) AS qtd FROM estabelecimento
LEFT JOIN dim_municipio ON codigo = municipio_cod GROUP BY ALL""")
def by_municipality(spark, sf):
    t = star.typed(spark, sf, "estabelecimento", "dim_municipio")
    rows = aggregates.by_municipality(t["estabelecimento"], t["dim_municipio"])
    return rows.select("municipio_cod", "municipio", "qtd")


_BITS = (
    ("none", {}, "true"),
    ("state", {"uf": "SP"}, "uf = 'SP'"),
    ("activity", {"cnae": "17"}, "cnae_fiscal_principal = 17"),
    ("any activity", {"cnae": "17", "secondary": True}, "(cnae_fiscal_principal = 17 OR cnpj IN (SELECT cnpj FROM bridge WHERE cnae_cod = 17))"),
    ("active, any activity", {"cnae": 20, "situacao": "2", "secondary": True},
     "situacao_cadastral = 2 AND (cnae_fiscal_principal = 20 OR cnpj IN (SELECT cnpj FROM bridge WHERE cnae_cod = 20))"),
    ("place", {"uf": "RJ", "situacao": 8, "municipio": "7"}, "uf = 'RJ' AND situacao_cadastral = 8 AND municipio_cod = 7"),
    ("unreadable", {"uf": "", "cnae": "abc", "situacao": "1.5"}, "true"),
    ("no such", {"uf": "ZZ", "situacao": "2"}, "uf = 'ZZ'"),
)


def _bitmaps(spark, sf) -> dict[str, DataFrame]:
    """The bitmaps alone, as published next to the branches."""
    root = work_path(spark, "bits")
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    publish.commit(spark, root, bitmaps.write_bitmaps(root, estab, _bridge(spark, sf)))
    return publish.tables(spark, root)


@query("c4_bitmap_filters", _REVERSE_SQL + " UNION ALL ".join(
    f"SELECT '{name}' AS filtro, count(*) AS total FROM estabelecimento WHERE {where}" for name, _, where in _BITS))
def bitmap_filters(spark, sf):
    """Filters on state, activity, listed activities, status and municipality, counted from the bitmaps alone."""
    t = _bitmaps(spark, sf)
    return reduce(DataFrame.unionByName, [
        bitmaps.count_branches(t, **given).select(F.lit(name).alias("filtro"), "total") for name, given, _ in _BITS])


@query("l4_bitmap_counts", _REVERSE_SQL + """
SELECT 'ativas' AS conta, CAST(cnae_fiscal_principal AS STRING) AS codigo, count(*) AS qtd
FROM estabelecimento WHERE situacao_cadastral = 2 GROUP BY 2
UNION ALL SELECT 'municipios', CAST(municipio_cod AS STRING), count(*) FROM estabelecimento WHERE uf = 'SP' GROUP BY 2
UNION ALL SELECT 'listadas', CAST(cnae_cod AS STRING), count(*) FROM estabelecimento JOIN bridge USING (cnpj)
WHERE situacao_cadastral = 2 AND uf = 'RJ' GROUP BY 2""")
def bitmap_counts(spark, sf):
    """Active branches by activity, a state's by municipality, a state's active ones by listed activity."""
    t = _bitmaps(spark, sf)
    parts = [("ativas", bitmaps.count_by(t, "cnae_fiscal_principal", situacao=2)), ("municipios", bitmaps.count_by(t, "municipio_cod", uf="SP")),
             ("listadas", bitmaps.count_by(t, bitmaps.SECONDARY, uf="RJ", situacao=2))]
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("conta"), "codigo", "qtd") for name, df in parts])


_CUBE = (
    ("total", (), {}, "true"), ("estado", (), {"uf": "SP"}, "uf = 'SP'"), ("atividade", (), {"cnae": "17"}, "cnae_fiscal_principal = 17"),
    ("ativas", ("uf",), {"situacao": 2}, "situacao_cadastral = 2"),
    ("lugar", ("municipio_cod",), {"uf": "RJ", "situacao": "8"}, "uf = 'RJ' AND situacao_cadastral = 8"),
    ("tudo", ("cnae_fiscal_principal",), {"uf": "MG", "situacao": "2", "municipio": 7}, "uf = 'MG' AND situacao_cadastral = 2 AND municipio_cod = 7"),
    ("ilegivel", ("situacao_cadastral",), {"uf": "", "cnae": "abc"}, "true"), ("nenhuma", (), {"uf": "ZZ"}, "uf = 'ZZ'"),
)


@query("e3_cube_routing", _sql("estabelecimento") + " UNION ALL ".join(
    f"SELECT '{name}' AS conta, {f'CAST({by[0]} AS VARCHAR)' if by else 'NULL'} AS chave, count(*) AS qtd FROM estabelecimento WHERE {where}"
    + (" GROUP BY 2" if by else "") for name, by, _, where in _CUBE))
def cube_routing(spark, sf):
    """Filters and groupings of branches, each from the smallest grouping of the published cube that fits."""
    root = work_path(spark, "cube")
    publish.commit(spark, root, cube.write_cube(root, star.typed(spark, sf, "estabelecimento")["estabelecimento"]))
    t = publish.tables(spark, root)
    return reduce(DataFrame.unionByName, [
        cube.count_by(t, by, **given).select(F.lit(name).alias("conta"), (F.col(by[0]) if by else F.lit(None)).cast("string").alias("chave"), "qtd")
        for name, by, given, _ in _CUBE])


@query("l6_frequent_pairs", _sql("estabelecimento") + """,
 p AS (SELECT 'lugar' AS par, uf AS a, CAST(municipio_cod AS VARCHAR) AS b, count(*) AS n FROM estabelecimento WHERE uf IS NOT NULL AND municipio_cod IS NOT NULL GROUP BY 2, 3
   UNION ALL SELECT 'atividade', CAST(cnae_fiscal_principal AS VARCHAR), CAST(situacao_cadastral AS VARCHAR), count(*) FROM estabelecimento
   WHERE cnae_fiscal_principal IS NOT NULL AND situacao_cadastral IS NOT NULL GROUP BY 2, 3)
SELECT par, a, b, n, n / sum(n) OVER (PARTITION BY par) AS parte FROM p
QUALIFY row_number() OVER (PARTITION BY par ORDER BY n DESC, a, b) <= 20""")
def frequent_pairs(spark, sf):
    """The twenty most frequent pairs of state and municipality, and of activity and status."""
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return reduce(DataFrame.unionByName, [
        frequent.frequent_pairs(estab, a, b, 20, 64).select(F.lit(name).alias("par"), "a", "b", "n", "parte")
        for name, a, b in (("lugar", "uf", "municipio_cod"), ("atividade", "cnae_fiscal_principal", "situacao_cadastral"))])


@query("l6_dependencies", _sql("estabelecimento") + """,
 p AS (SELECT municipio_cod AS a, uf AS b, count(*) AS n FROM estabelecimento WHERE municipio_cod IS NOT NULL AND uf IS NOT NULL GROUP BY 1, 2)
SELECT CAST(a AS VARCHAR) AS a, CAST(sum(n) AS BIGINT) AS n, arg_max(b, (n, -rank)) AS b, max(n) / sum(n) AS grau
FROM (SELECT *, row_number() OVER (ORDER BY b) AS rank FROM p) GROUP BY 1""")
def dependencies(spark, sf):
    """How far each municipality decides the state."""
    return frequent.dependencies(star.typed(spark, sf, "estabelecimento")["estabelecimento"], "municipio_cod", "uf")


@query("l5_by_size", _sql("empresa", "dim_porte") + """
SELECT porte_cod, descricao AS porte, count(*) AS qtd FROM empresa
LEFT JOIN dim_porte ON codigo = porte_cod GROUP BY ALL""")
def by_size(spark, sf):
    t = star.typed(spark, sf, "empresa", "dim_porte")
    return aggregates.by_size(t["empresa"], t["dim_porte"])


def _profile_sql(a: str, b: str) -> str:
    return _sql("estabelecimento") + f""", pairs AS (
      SELECT {a} AS a, {b} AS b, count(*) AS n FROM estabelecimento
      WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL),
    by_a AS (SELECT a, sum(n) AS n, count(*) AS others FROM pairs GROUP BY a),
    by_b AS (SELECT b, sum(n) AS n, count(*) AS others FROM pairs GROUP BY b)
    SELECT CAST((SELECT sum(n) FROM pairs) AS BIGINT) AS linhas, (SELECT count(*) FROM by_a) AS distintos_a,
           (SELECT count(*) FROM by_b) AS distintos_b, (SELECT count(*) FROM pairs) AS distintos_par,
           (SELECT coalesce(sum(n) FILTER (others = 1), 0) / sum(n) FROM by_a) AS a_decide_b,
           (SELECT coalesce(sum(n) FILTER (others = 1), 0) / sum(n) FROM by_b) AS b_decide_a"""


@query("l6_profile_place", _profile_sql("uf", "municipio_cod"))
def profile_place(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return aggregates.profile_pairs(estab, "uf", "municipio_cod")


@query("l6_profile_activity", _profile_sql("cnae_fiscal_principal", "situacao_cadastral"))
def profile_activity(spark, sf):
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    return aggregates.profile_pairs(estab, "cnae_fiscal_principal", "situacao_cadastral")


@query("l6_profile_approximate", f"""
SELECT linhas, true AS perto_a, true AS perto_b, true AS perto_par
FROM ({_profile_sql("cnae_fiscal_principal", "situacao_cadastral")})""")
def profile_approximate(spark, sf):
    """The sketches' counts, each within a tenth of the exact one."""
    estab = star.typed(spark, sf, "estabelecimento")["estabelecimento"]
    columns = ("cnae_fiscal_principal", "situacao_cadastral")
    counts = ["linhas", "distintos_a", "distintos_b", "distintos_par"]
    both = aggregates.profile_pairs(estab, *columns, approximate=True).select(*counts, F.lit(True).alias("rough")).unionByName(
        aggregates.profile_pairs(estab, *columns).select(*counts, F.lit(False).alias("rough")))
    of = {(c, r): F.max(F.when(F.col("rough") == r, F.col(c))) for c in counts for r in (True, False)}
    near = [(F.abs(of[f"distintos_{c}", True] - of[f"distintos_{c}", False]) <= 0.1 * of[f"distintos_{c}", False]).alias(
        f"perto_{c}") for c in ("a", "b", "par")]
    return both.agg(of["linhas", True].alias("linhas"), *near)


# --- sampling ----------------------------------------------------------------------------

_SAMPLE = 500
_ANCHOR_SQL = f"anchor AS (SELECT * FROM stg_estabelecimentos ORDER BY {', '.join(ARRIVAL)} LIMIT {_SAMPLE})"


@query("a10_sample_anchor", _sql("stg_estabelecimentos") + f", {_ANCHOR_SQL}" + """
SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM anchor""")
def sample_anchor(spark, sf):
    estab = star.staging(spark, sf, "estabelecimentos")["estabelecimentos"]
    return sample.sample_anchor(estab, _SAMPLE).select("cnpj_basico", "cnpj_ordem", "cnpj_dv")


_SAMPLED = ("empresas", "estabelecimentos", "socios", "simples", "regime")


@query("d7_coherent_sample", _sql(*(f"stg_{f}" for f in _SAMPLED)) + f", {_ANCHOR_SQL}" + """
SELECT 'empresas' AS t, cnpj_basico, count(*) AS linhas FROM stg_empresas
WHERE cnpj_basico IN (SELECT cnpj_basico FROM anchor) GROUP BY 2
UNION ALL SELECT 'estabelecimentos', cnpj_basico, count(*) FROM anchor GROUP BY 2
UNION ALL SELECT 'socios', cnpj_basico, count(*) FROM stg_socios
WHERE cnpj_basico IN (SELECT cnpj_basico FROM anchor) GROUP BY 2
UNION ALL SELECT 'simples', cnpj_basico, count(*) FROM stg_simples
WHERE cnpj_basico IN (SELECT cnpj_basico FROM anchor) GROUP BY 2""")
def coherent_sample(spark, sf):
    feeds_ = star.staging(spark, sf, *_SAMPLED)
    kept = sample.coherent_sample(feeds_, _SAMPLE)
    counts = [
        kept[f].groupBy("cnpj_basico").agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(f).alias("t"), "cnpj_basico", "linhas")
        for f in _SAMPLED if f != "regime"
    ]
    return reduce(DataFrame.unionByName, counts)


# --- raw feeds ---------------------------------------------------------------------------

# Text a reader can stumble over: quotes, separators, a line break, a trailing backslash,
# characters of ISO-8859-15 and, on the way in, NUL bytes.
_HARD_SPARK = "c_name || ' \"Cia\"; €5 Šé\\\\' || chr(10) || 'fim\\\\'"
_HARD_DUCK = "c_name || ' \"Cia\"; €5 Šé\\' || chr(10) || 'fim\\'"


def _hard(spark, sf, nul: bool = False):
    customers = star.source(spark, sf, "customer")
    name = F.expr(_HARD_SPARK)
    if nul:
        name = F.concat(F.lit("\u0000"), F.substring(name, 1, 4), F.lit("\u0000"), F.substring(name, 5, 1000))
    blank = F.when(F.col("c_custkey") % 3 == 0, None).when(F.col("c_custkey") % 3 == 1, "").otherwise("x")
    return customers.select(
        F.col("c_custkey").cast("string").alias("codigo"), name.alias("descricao"), blank.alias("vazio")
    )


_HARD_SQL = f"""SELECT CAST(c_custkey AS STRING) AS codigo, {_HARD_DUCK} AS descricao,
       CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'x' END AS vazio FROM customer"""
_HARD_SCHEMA = "codigo string, descricao string, vazio string"


def _schema(spark, ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


# Records of an archive.
_ARCHIVE_ROWS = 1_000_000


def _archives(rows: DataFrame, least: int) -> int:
    return max(least, -(-rows.count() // _ARCHIVE_ROWS))


def _dealt(rows: DataFrame, least: int, key: str) -> DataFrame:
    """Rows dealt to as many archives as they need, ``least`` or more."""
    return rows.repartition(_archives(rows, least), key)


@query("a1_zip_scan", _HARD_SQL)
def zip_scan(spark, sf):
    folder = write_archives(_dealt(_hard(spark, sf), 3, "codigo"), work_path(spark, "a1"), "Feed", members=2)
    rows = feeds.read_zip_csv(spark, f"{folder}/Feed*.zip", _schema(spark, _HARD_SCHEMA))
    return rows.select("codigo", "descricao", "vazio")


@query("a2_plain_scan", _HARD_SQL)
def plain_scan(spark, sf):
    folder = write_archives(_dealt(_hard(spark, sf), 3, "codigo"), work_path(spark, "a2"), "Feed", zipped=False)
    rows = feeds.read_registry_csv(spark, folder, _schema(spark, _HARD_SCHEMA))
    return rows.select("codigo", "descricao", "vazio")


@query("a3_regime_scan", _sql("stg_regime") + f"SELECT * EXCLUDE ({', '.join(ARRIVAL)}) FROM stg_regime")
def regime_scan(spark, sf):
    rows = _dealt(star.staging(spark, sf, "regime")["regime"].drop(*ARRIVAL), 2, "cnpj")
    folder = write_archives(rows, work_path(spark, "a3"), "entidades-", sep=",", charset="utf8", header=True,
                            members=3, newline="\r\n")
    return feeds.read_feed(spark, folder, "regime").drop(*ARRIVAL)


@query("a4_nul_bytes", _HARD_SQL)
def nul_bytes(spark, sf):
    folder = write_archives(_dealt(_hard(spark, sf, nul=True), 2, "codigo"), work_path(spark, "a4"), "Feed")
    rows = feeds.read_zip_csv(spark, f"{folder}/Feed*.zip", _schema(spark, _HARD_SCHEMA))
    return rows.select("codigo", "descricao", "vazio")


@query("a5_lookup_scan", "SELECT CAST(n_nationkey AS STRING) AS codigo, n_name AS descricao FROM nation")
def lookup_scan(spark, sf):
    nations = star.source(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("descricao"))
    folder = write_archives(nations, work_path(spark, "a5"), "Naturezas")
    return feeds.read_lookup(spark, f"{folder}/Naturezas*.zip").drop(*ARRIVAL)


_FEEDS = ("empresas", "estabelecimentos", "socios", "simples", "regime", "naturezas", "cnaes")


@query("a6_all_text_feeds", _sql(*(f"stg_{f}" for f in _FEEDS)) + " UNION ALL ".join(
    f"SELECT '{f}' AS feed, count(*) AS linhas, {len(STAGING_SCHEMAS[f])} AS colunas FROM stg_{f}"
    for f in _FEEDS))
def all_text_feeds(spark, sf):
    folder = _snapshot(spark, sf)
    counts = []
    for f in _FEEDS:
        rows = feeds.read_feed(spark, folder, f).drop(*ARRIVAL)
        width = sum(t.dataType == STAGING_SCHEMAS[f][t.name].dataType for t in rows.schema)
        counts.append(rows.agg(F.lit(f).alias("feed"), F.count(F.lit(1)).alias("linhas"),
                               F.lit(width).alias("colunas")))
    return reduce(DataFrame.unionByName, counts)


_SNAPSHOTS: dict[tuple[str, str], str] = {}


def _snapshot(spark, sf) -> str:
    """A snapshot folder with archives of every feed there is data for; made once per
    application."""
    made = (spark.sparkContext.applicationId, sf)
    if made in _SNAPSHOTS:
        return _SNAPSHOTS[made]
    folder = work_path(spark, "snapshot")
    for feed in _FEEDS:
        # Archives follow the order of the rows, as arrival decides between copies of a key.
        many = "*" in FEED_GLOBS[feed]
        rows = star.arriving(spark, sf, feed, lambda table: _archives(table, 3) if many else 1)
        name, text = _ARCHIVES[feed], rows.drop(*ARRIVAL)
        if feed == "regime":
            write_archives(text, folder, name, sep=",", charset="utf8", header=True, members=2)
        else:
            write_archives(text, folder, name, numbered=many)
    _SNAPSHOTS[made] = folder
    return folder


_ARCHIVES = {
    "empresas": "Empresas", "estabelecimentos": "Estabelecimentos", "socios": "Socios",
    "simples": "Simples", "regime": "entidades-", "naturezas": "Naturezas", "cnaes": "Cnaes",
}


@query("a8_missing_feed", _sql("stg_empresas") + """
SELECT 'empresas' AS feed, count(*) AS linhas FROM stg_empresas UNION ALL SELECT 'socios', 0""")
def missing_feed(spark, sf):
    rows = star.staging(spark, sf, "empresas")["empresas"].drop(*ARRIVAL)
    folder = write_archives(rows, work_path(spark, "a8"), "Empresas")
    counts = [
        feeds.read_feed(spark, folder, f).agg(F.lit(f).alias("feed"), F.count(F.lit(1)).alias("linhas"))
        for f in ("empresas", "socios")
    ]
    return counts[0].unionByName(counts[1])


@query("h2_concatenated_archives", _sql("stg_socios") + """
SELECT cnpj_basico, count(*) AS linhas FROM stg_socios GROUP BY 1""")
def concatenated_archives(spark, sf):
    rows = _dealt(star.staging(spark, sf, "socios")["socios"].drop(*ARRIVAL), 4, "cnpj_basico")
    folder = write_archives(rows, work_path(spark, "h2"), "Socios", members=2)
    return feeds.read_feed(spark, folder, "socios").groupBy("cnpj_basico").agg(
        F.count(F.lit(1)).alias("linhas"))


# --- publication -------------------------------------------------------------------------

def _publish(spark, sf, root, *names, **options):
    for name, df in star.typed(spark, sf, *names).items():
        publish.publish(df, root, name, load.PARTITIONED.get(name), load.CLUSTERED.get(name, ()),
                        load.BLOOM.get(name, ()), **options)


@query("b1_full_replace", _sql("empresa") + """
SELECT 2 AS publicacoes, porte_cod, count(*) AS linhas FROM empresa GROUP BY 2""")
def full_replace(spark, sf):
    root = work_path(spark, "b1")
    _publish(spark, sf, root, "empresa")
    _publish(spark, sf, root, "empresa")
    log = publish.commit_log(spark, root).agg(F.count(F.lit(1)).cast("int").alias("publicacoes"))
    sizes = publish.read_table(spark, root, "empresa").groupBy("porte_cod").agg(F.count(F.lit(1)).alias("linhas"))
    return sizes.withColumn("publicacoes", F.lit(log.first()[0])).select("publicacoes", "porte_cod", "linhas")


@query("b2_state_partitions", _sql("estabelecimento") + """
SELECT uf, cnpj, situacao_cadastral FROM estabelecimento WHERE uf IN ('??', 'SP')""")
def state_partitions(spark, sf):
    root = work_path(spark, "b2")
    _publish(spark, sf, root, "estabelecimento")
    rows = publish.read_table(spark, root, "estabelecimento")
    return rows.filter(F.col("uf").isin("??", "SP")).select("uf", "cnpj", "situacao_cadastral")


@query("a9_published_tables", _sql("empresa", "simples") + """
SELECT opcao_simples, count(*) AS empresas FROM empresa LEFT JOIN simples USING (cnpj_basico) GROUP BY 1""")
def published_tables(spark, sf):
    root = work_path(spark, "a9")
    _publish(spark, sf, root, "empresa", "simples")
    t = publish.tables(spark, root)
    return t["empresa"].join(t["simples"], "cnpj_basico", "left").groupBy("opcao_simples").agg(
        F.count(F.lit(1)).alias("empresas"))


@query("b5_regime_refresh", _REGIME_SQL + f", {_sql('empresa')[5:]}" + """
SELECT r.linhas, r.empresas, r.ano_min, r.ano_max, e.cadastradas FROM
 (SELECT count(*) AS linhas, count(DISTINCT cnpj_basico) AS empresas, min(ano) AS ano_min, max(ano) AS ano_max
  FROM regime) r, (SELECT count(*) AS cadastradas FROM empresa) e""")
def regime_refresh(spark, sf):
    root = work_path(spark, "b5")
    _publish(spark, sf, root, "empresa", "regime_tributario")
    rows = _dealt(star.staging(spark, sf, "regime")["regime"].drop(*ARRIVAL), 2, "cnpj")
    folder = write_archives(rows, work_path(spark, "b5in"), "entidades-", sep=",", charset="utf8", header=True)
    summary = load.load_regime(spark, folder, root)
    companies = publish.read_table(spark, root, "empresa").count()
    return summary.withColumn("cadastradas", F.lit(companies).cast("long"))


_CHANGED_SQL = _sql("empresa", "estabelecimento") + """,
 novas AS (SELECT * REPLACE (CASE WHEN CAST(cnpj_basico AS INT) % 97 = 3 THEN CAST(1 AS SMALLINT) ELSE natureza_juridica_cod END AS natureza_juridica_cod,
             CASE WHEN CAST(cnpj_basico AS INT) % 89 = 5 THEN NULL ELSE capital_social END AS capital_social)
           FROM empresa WHERE CAST(cnpj_basico AS INT) % 101 <> 7),
 filiais AS (SELECT * REPLACE (CASE WHEN CAST(cnpj_basico AS INT) % 83 = 1 THEN CAST(8 AS SMALLINT) ELSE situacao_cadastral END AS situacao_cadastral)
             FROM estabelecimento)
"""


@query("b6_incremental_marts", _CHANGED_SQL + """
SELECT 'capital' AS mart, CAST(natureza_juridica_cod AS INT) AS chave, count(*) AS n, CAST(sum(capital_social) AS DOUBLE) AS total FROM novas GROUP BY 2
UNION ALL SELECT 'ativas', municipio_cod, count(*), NULL FROM filiais WHERE situacao_cadastral = 2 GROUP BY 2""")
def incremental_marts(spark, sf):
    """Aggregates after companies have gone, changed their category and lost their capital, and branches have closed, brought up to
    date by the difference of the two versions."""
    root = work_path(spark, "b6i")
    old = star.typed(spark, sf, "empresa", "estabelecimento")
    number = F.col("cnpj_basico").cast("int")
    category = F.when(number % 97 == 3, F.lit(1).cast("short")).otherwise(F.col("natureza_juridica_cod"))
    capital = F.when(number % 89 != 5, F.col("capital_social"))
    status = F.when(number % 83 == 1, F.lit(8).cast("short")).otherwise(F.col("situacao_cadastral"))
    new = {"empresa": old["empresa"].filter(number % 101 != 7).withColumn("natureza_juridica_cod", category).withColumn("capital_social", capital),
           "estabelecimento": old["estabelecimento"].withColumn("situacao_cadastral", status)}
    for version in (old, new):
        publish.commit(spark, root, load.write_tables(root, version))
        incremental.refresh_incremental(spark, root)
    t = publish.tables(spark, root)
    rows = t[marts.CAPITAL].select(F.lit("capital").alias("mart"), F.col("natureza_juridica_cod").cast("int").alias("chave"),
                                   F.col("empresas").alias("n"), F.col("capital_total").cast("double").alias("total"))
    places = t[marts.ACTIVE].groupBy(F.col("municipio_cod").alias("chave")).agg(F.sum("qtd").alias("n"))
    return rows.unionByName(places.select(F.lit("ativas").alias("mart"), "chave", "n", F.lit(None).cast("double").alias("total")))


@query("b6_refresh_marts", _sql("empresa", "estabelecimento") + """
SELECT 'capital' AS mart, natureza_juridica_cod AS chave, count(*) AS n,
       CAST(sum(capital_social) AS DOUBLE) AS total FROM empresa GROUP BY 2
UNION ALL SELECT 'ativas', municipio_cod, count(*), NULL FROM estabelecimento
WHERE situacao_cadastral = 2 GROUP BY 2""")
def refresh_marts(spark, sf):
    root = work_path(spark, "b6")
    _publish(spark, sf, root, "empresa", "estabelecimento")
    marts.refresh_marts(spark, root)
    t = publish.tables(spark, root)
    capital = t[marts.CAPITAL].select(
        F.lit("capital").alias("mart"), F.col("natureza_juridica_cod").cast("int").alias("chave"),
        F.col("empresas").alias("n"), F.col("capital_total").cast("double").alias("total"))
    places = t[marts.ACTIVE].groupBy(F.col("municipio_cod").alias("chave")).agg(F.sum("qtd").alias("n"))
    return capital.unionByName(places.select(
        F.lit("ativas").alias("mart"), "chave", "n", F.lit(None).cast("double").alias("total")))


@query("e8_published_ranking", _sql("empresa", "dim_natureza_juridica") + f"""
SELECT descricao AS natureza_juridica, empresas, capital_total FROM ({_MART_SQL})
LEFT JOIN dim_natureza_juridica ON codigo = natureza_juridica_cod""")
def published_ranking(spark, sf):
    """The whole ranking, read from the published aggregate: the company table is not among the tables."""
    root = work_path(spark, "e8")
    _publish(spark, sf, root, "empresa", "estabelecimento", "dim_natureza_juridica")
    marts.refresh_marts(spark, root)
    t = publish.tables(spark, root)
    return _doubles(marts.capital_ranking({k: df for k, df in t.items() if k != "empresa"}), "capital_total")


@query("b1_full_load", f"""
WITH {_sql(*(f'stg_{f}' for f in _FEEDS if f != 'regime'))[5:]}, {_REGIME_SQL[5:]}
SELECT 'empresa' AS t, count(DISTINCT cnpj_basico) AS count FROM stg_empresas WHERE {_IS_BASE}
UNION ALL SELECT 'estabelecimento', count(DISTINCT (cnpj_basico, cnpj_ordem, cnpj_dv,
     {_value_sql('state', ('uf',))})) FROM stg_estabelecimentos WHERE {_IS_BASE}
UNION ALL SELECT 'socio', count(*) FROM stg_socios WHERE {_IS_BASE}
UNION ALL SELECT 'simples', count(DISTINCT cnpj_basico) FROM stg_simples WHERE {_IS_BASE}
UNION ALL SELECT 'regime_tributario', count(*) FROM regime""")
def full_load(spark, sf):
    return load.load_registry(spark, _snapshot(spark, sf), work_path(spark, "registry"), month="2001-08")


def _line_sql(table: str, columns: list[str], rows: str) -> str:
    """Rows of a table as one text each, next to the table's name."""
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"SELECT '{table}' AS t, concat_ws('|', {texts}) AS linha FROM ({rows})"


def _lines(t: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        t[name].select(F.lit(name).alias("t"), F.concat_ws(
            "|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in names)).alias("linha"))
        for name, names in columns.items()
    ])


_LOADED = {t: [name for name, _, _ in TYPED_COLUMNS[t]] for t in FACT_FEEDS} | {
    "estabelecimento_cnae_secundario": ["cnpj", "cnae_cod"],
    "dim_natureza_juridica": ["codigo", "descricao"], "dim_cnae": ["codigo", "descricao"],
    marts.CAPITAL: ["natureza_juridica_cod", "empresas", "capital_total"],
    marts.ACTIVE: ["uf", "municipio_cod", "cnae_fiscal_principal", "qtd"],
}
_LOADED_SQL = {t: _typed_sql(t) for t in FACT_FEEDS} | {
    "empresa": "SELECT * REPLACE (CAST(capital_social AS DECIMAL(18, 2)) AS capital_social) FROM (" + _typed_sql("empresa") + ")",
    "estabelecimento_cnae_secundario": ORACLE["i12_explode_codes"][len(_sql("stg_estabelecimentos")):],
    "dim_natureza_juridica": _lookup_sql("naturezas", "SMALLINT")[len(_sql("stg_naturezas")):],
    "dim_cnae": _lookup_sql("cnaes", "INT")[len(_sql("stg_cnaes")):],
    marts.CAPITAL: f"""SELECT natureza_juridica_cod, count(*) AS empresas, CAST(sum(CAST(capital_social AS DECIMAL(18, 2)))
        AS DECIMAL(38, 2)) AS capital_total FROM ({_typed_sql('empresa')}) GROUP BY 1""",
    marts.ACTIVE: f"""SELECT uf, municipio_cod, cnae_fiscal_principal, count(*) AS qtd
        FROM ({_typed_sql('estabelecimento')}) WHERE situacao_cadastral = 2 GROUP BY ALL""",
}


@query("b1_full_load_contents", _sql(*(f"stg_{f}" for f in _FEEDS)) + " UNION ALL ".join(
    _line_sql(t, columns, _LOADED_SQL[t]) for t, columns in _LOADED.items()))
def full_load_contents(spark, sf):
    """Every row of the tables that a load from archives publishes."""
    root = work_path(spark, "registry")
    load.load_registry(spark, _snapshot(spark, sf), root)
    return _lines(publish.tables(spark, root), _LOADED)


@query("a8_missing_establishments", _sql("stg_empresas") + f"""
SELECT 'empresa' AS t, count(DISTINCT cnpj_basico) AS count FROM stg_empresas WHERE {_IS_BASE}
UNION ALL SELECT unnest(['estabelecimento', 'socio', 'simples', 'regime_tributario']), 0""")
def missing_establishments(spark, sf):
    """A load from a folder that holds the companies only; the tables are read back."""
    rows = star.staging(spark, sf, "empresas")["empresas"].repartitionByRange(3, *ARRIVAL).drop(*ARRIVAL)
    folder, root = write_archives(rows, work_path(spark, "a8in"), "Empresas"), work_path(spark, "a8")
    load.load_registry(spark, folder, root)
    return aggregates.load_audit(publish.tables(spark, root))


@query("b9_load_rejects", """
SELECT 'dim_natureza_juridica' AS t, count(*) AS count FROM nation WHERE n_nationkey % 4 <> 1
UNION ALL SELECT 'rejects_dim_natureza_juridica', count(*) FROM nation WHERE n_nationkey % 4 = 1
UNION ALL SELECT 'empresa', count(*) FROM part
UNION ALL SELECT 'rejects_empresa', count(*) FROM part WHERE p_partkey * 40 > 32767
UNION ALL SELECT 'rejects_records', count(*) FROM part
UNION ALL SELECT 'regime_tributario', count(*) FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'rejects_regime_tributario', count(*) FROM customer WHERE c_custkey % 5 = 0""")
def load_rejects(spark, sf):
    """Codes too large, years too large and lines of the wrong width: published and rejected rows
    account for every input row. The feeds come as many archives; the lookup file has a row per nation."""
    folder, root = work_path(spark, "b9in"), work_path(spark, "b9")
    part = star.source(spark, sf, "part")
    code, key = (F.col("p_partkey") * 40).cast("string"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")
    blank = F.lit("")
    companies = part.select(key.alias("cnpj_basico"), F.col("p_name").alias("razao_social"), code.alias("natureza_juridica"),
                            *(blank.alias(c) for c in STAGING_COLUMNS["empresas"][3:]))
    write_archives(_dealt(companies, 3, "cnpj_basico"), folder, "Empresas")
    write_archives(_dealt(part.select(code.alias("a"), code.alias("b"), code.alias("c")), 3, "a"), folder, "Socios")
    nations = star.source(spark, sf, "nation").select(
        F.when(F.col("n_nationkey") % 4 == 1, "99999").otherwise(F.col("n_nationkey").cast("string")).alias("codigo"),
        F.col("n_name").alias("descricao"))
    write_archives(nations.coalesce(1), folder, "Naturezas", numbered=False)
    year = F.when(F.col("c_custkey") % 5 == 0, "99999").otherwise("2024")
    cnpj = F.lpad(F.col("c_custkey").cast("string"), 14, "0")
    regimes = star.source(spark, sf, "customer").select(
        year.alias("ano"), cnpj.alias("cnpj"), F.lit("0").alias("cnpj_da_scp"),
        F.lit("LUCRO REAL").alias("forma_de_tributacao"), F.lit("1").alias("quantidade_de_escrituracoes"))
    write_archives(_dealt(regimes, 2, "cnpj"), folder, "entidades-", sep=",", charset="utf8", header=True)
    load.load_registry(spark, folder, root, strict=False)
    return aggregates.load_audit(publish.tables(spark, root), (
        "dim_natureza_juridica", "rejects_dim_natureza_juridica", "empresa", "rejects_empresa", "rejects_records",
        "regime_tributario", "rejects_regime_tributario"))


# --- snapshots ---------------------------------------------------------------------------

def _by_month(spark, sf):
    return star.source(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


@query("j2_latest_snapshot", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)""")
def latest_snapshot(spark, sf):
    return snapshots.latest_snapshot(_by_month(spark, sf)).select("o_orderkey", "o_custkey", "month")


@query("j1_ingest_new_months", """
SELECT o_orderkey, o_custkey, 2 AS publicacoes FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)""")
def ingest_new_months(spark, sf):
    """All months but the last arrive and are ingested, then the last; a third call has
    nothing to do. Each of the first two calls publishes its newest month."""
    folder, root, state = (work_path(spark, n) for n in ("j1in", "j1", "j1state"))
    orders = _by_month(spark, sf)
    last = orders.agg(F.max("month")).first()[0]

    def load_month(session, path, month):
        publish.publish(session.read.parquet(path), root, "orders", month=month)

    for arriving in (F.col("month") < last, F.col("month") == last, None):
        if arriving is not None:
            orders.filter(arriving).write.mode("append").partitionBy("month").parquet(folder)
        snapshots.ingest_new_months(spark, folder, root, state, load_month, [r"\.parquet$"], "*.parquet")
    done = publish.commit_log(spark, root).count()
    rows = publish.read_table(spark, root, "orders")
    return rows.select("o_orderkey", "o_custkey", F.lit(done).alias("publicacoes"))


_ARRIVALS = ("1997-06", "2000-02", "9999-12")


@query("j4_marts_after_load", _sql("estabelecimento", "empresa") + """,
 e AS (SELECT *, strftime(data_inicio_atividade, '%Y-%m') AS mes FROM estabelecimento),
 m AS (""" + " UNION ".join(f"SELECT max(mes) AS mes FROM e WHERE mes <= '{until}'" for until in _ARRIVALS) + """)
SELECT 'ativas' AS mart, mes, uf AS chave, count(*) AS n FROM e WHERE situacao_cadastral = 2 AND mes IN (SELECT mes FROM m) GROUP BY 2, 3
UNION ALL SELECT 'capital', mes, CAST(natureza_juridica_cod AS VARCHAR), count(*) FROM empresa, m GROUP BY 2, 3
UNION ALL SELECT 'filiais', mes, NULL, count(*) FROM e WHERE mes IN (SELECT mes FROM m) GROUP BY 2""")
def marts_after_load(spark, sf):
    """All months arrive in three parts; each part's newest is loaded, and its aggregates are fresh with it."""
    folder, root, state = (work_path(spark, n) for n in ("j4in", "j4", "j4state"))
    t = star.typed(spark, sf, "estabelecimento", "empresa")
    rows = t["estabelecimento"].withColumn("month", F.date_format("data_inicio_atividade", "yyyy-MM"))

    def load_month(session, path, found):
        paths = load.write_tables(root, {"estabelecimento": session.read.parquet(path), "empresa": t["empresa"]})
        written = {name: session.read.parquet(p) for name, p in paths.items()}
        paths |= marts.write_marts(session, root, written["empresa"], written["estabelecimento"])
        publish.commit(session, root, paths, found)

    after = ""
    for until in _ARRIVALS:
        rows.filter((F.col("month") > after) & (F.col("month") <= until)).write.mode("append").partitionBy("month").parquet(folder)
        snapshots.ingest_new_months(spark, folder, root, state, load_month, [r"\.parquet$"], "*.parquet")
        after = until
    out = []
    # Three loads, each a row per table.
    for r in publish.commit_log(spark, root).collect():
        df = spark.read.parquet(r.path)
        shape = {marts.ACTIVE: ("ativas", F.col("uf"), "qtd"), marts.CAPITAL: ("capital", F.col("natureza_juridica_cod"), "empresas"),
                 "estabelecimento": ("filiais", F.lit(None), None)}.get(r.table_name)
        if shape:
            name, key, amount = shape
            n = F.sum(amount) if amount else F.count(F.lit(1))
            out.append(df.groupBy(key.cast("string").alias("chave")).agg(n.alias("n")).select(
                F.lit(name).alias("mart"), F.lit(r.month).alias("mes"), "chave", "n"))
    return reduce(DataFrame.unionByName, out)


@query("j3_optional_regime", """
WITH m(mes, regimes) AS (VALUES ('2024-01', true), ('2024-02', true), ('2024-03', false))
SELECT mes, 'empresa' AS t, count(*) AS count FROM customer, m GROUP BY 1
UNION ALL SELECT mes, 'regime_tributario', (SELECT count(*) FROM customer) * CAST(regimes AS INT) FROM m""")
def optional_regime(spark, sf):
    """Three months of archives through the ingest: regimes that are there, broken (those of the month before
    stay) and absent (none)."""
    top, root, state = (work_path(spark, n) for n in ("j3in", "j3", "j3state"))
    customer, small = star.source(spark, sf, "customer"), star.source(spark, sf, "nation")
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    blank = F.lit("")
    companies = customer.select(key.alias("cnpj_basico"), F.col("c_name").alias("razao_social"),
                                *(blank.alias(c) for c in STAGING_COLUMNS["empresas"][2:]))
    regimes = customer.select(F.lit("2024").alias("ano"), F.concat(key, F.lit("000100")).alias("cnpj"), F.lit("0").alias("cnpj_da_scp"),
                              F.lit("LUCRO REAL").alias("forma_de_tributacao"), F.lit("1").alias("quantidade_de_escrituracoes"))
    id_ = F.lpad(F.col("n_nationkey").cast("string"), 8, "0")
    out = []
    for month, with_regimes in (("2024-01", True), ("2024-02", None), ("2024-03", False)):
        folder = f"{top}/{month}"
        write_archives(_dealt(companies, 2, "cnpj_basico"), folder, "Empresas")
        for feed, name in (("estabelecimentos", "Estabelecimentos"), ("socios", "Socios"), ("simples", "Simples")):
            rows = small.select(id_.alias("cnpj_basico"), *(blank.alias(c) for c in STAGING_COLUMNS[feed][1:])).coalesce(1)
            write_archives(rows, folder, name, numbered=False)
        for feed in ("cnaes", "naturezas", "qualificacoes", "paises", "motivos", "municipios"):
            rows = small.select(F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("descricao")).coalesce(1)
            write_archives(rows, folder, FEED_GLOBS[feed].removesuffix(".zip"), numbered=False)
        if with_regimes:
            write_archives(_dealt(regimes, 2, "cnpj"), folder, "entidades-", sep=",", charset="utf8", header=True)
        elif with_regimes is None:
            files, path = open_fs(f"{folder}/entidades-1.zip")
            with files.open_output_stream(path) as f:
                f.write(b"PK\x03\x04 cut off")
        snapshots.ingest_registry(spark, top, root, state)
        audit = aggregates.load_audit(publish.tables(spark, root), ("empresa", "regime_tributario"))
        out.append(audit.select(F.lit(publish.published_month(spark, root)).alias("mes"), "t", "count"))
    return reduce(DataFrame.unionByName, out)
