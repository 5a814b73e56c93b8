"""Fixed schemas: all-text staging feeds, typed tables, seeded domains."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

# Columns of each raw feed, in file order.
STAGING_COLUMNS = {
    "empresas": (
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_resp",
        "capital_social", "porte", "ente_federativo",
    ),
    "estabelecimentos": (
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
        "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
        "motivo_situacao", "nome_cidade_exterior", "pais", "data_inicio_atividade",
        "cnae_principal", "cnae_secundaria", "tipo_logradouro", "logradouro", "numero",
        "complemento", "bairro", "cep", "uf", "municipio", "ddd_1", "telefone_1",
        "ddd_2", "telefone_2", "ddd_fax", "fax", "correio_eletronico",
        "situacao_especial", "data_situacao_especial",
    ),
    "socios": (
        "cnpj_basico", "identificador_socio", "nome_socio", "cnpj_cpf_socio",
        "qualificacao_socio", "data_entrada_sociedade", "pais", "cpf_representante",
        "nome_representante", "qualificacao_repr", "faixa_etaria",
    ),
    "simples": (
        "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
        "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
    ),
    "regime": (
        "ano", "cnpj", "cnpj_da_scp", "forma_de_tributacao",
        "quantidade_de_escrituracoes",
    ),
    "cnaes": ("codigo", "descricao"),
    "naturezas": ("codigo", "descricao"),
    "qualificacoes": ("codigo", "descricao"),
    "paises": ("codigo", "descricao"),
    "motivos": ("codigo", "descricao"),
    "municipios": ("codigo", "descricao"),
}

# Archive name pattern of each feed.
FEED_GLOBS = {
    "empresas": "Empresas*.zip",
    "estabelecimentos": "Estabelecimentos*.zip",
    "socios": "Socios*.zip",
    "simples": "Simples.zip",
    "regime": "entidades-*.zip",
    "cnaes": "Cnaes.zip",
    "naturezas": "Naturezas.zip",
    "qualificacoes": "Qualificacoes.zip",
    "paises": "Paises.zip",
    "motivos": "Motivos.zip",
    "municipios": "Municipios.zip",
}

# Where a row came from; these order "first" when a key arrives twice.
FILE, LINE = "_file", "_line"
ARRIVAL = (FILE, LINE)
# Text of a record of the wrong width.
CORRUPT = "_corrupt_record"


def staging_schema(feed: str, arrival: bool = False) -> StructType:
    fields = [StructField(name, StringType()) for name in STAGING_COLUMNS[feed]]
    if arrival:
        fields += [StructField(FILE, StringType()), StructField(LINE, LongType())]
    return StructType(fields)


STAGING_SCHEMAS = {feed: staging_schema(feed) for feed in STAGING_COLUMNS}

# Typed tables: (column, kind, staging columns). The kinds are explained in
# regiscope/operators/transform.py.
TYPED_COLUMNS = {
    "empresa": (
        ("cnpj_basico", "as is", ("cnpj_basico",)),
        ("razao_social", "text", ("razao_social",)),
        ("natureza_juridica_cod", "smallint", ("natureza_juridica",)),
        ("qualificacao_resp_cod", "smallint", ("qualificacao_resp",)),
        ("capital_social", "money", ("capital_social",)),
        ("porte_cod", "smallint", ("porte",)),
        ("ente_federativo", "text", ("ente_federativo",)),
    ),
    "estabelecimento": (
        ("cnpj", "joined", ("cnpj_basico", "cnpj_ordem", "cnpj_dv")),
        ("cnpj_basico", "as is", ("cnpj_basico",)),
        ("matriz_filial", "smallint", ("identificador_matriz_filial",)),
        ("nome_fantasia", "text", ("nome_fantasia",)),
        ("situacao_cadastral", "smallint", ("situacao_cadastral",)),
        ("data_situacao_cadastral", "date", ("data_situacao_cadastral",)),
        ("motivo_situacao_cod", "smallint", ("motivo_situacao",)),
        ("nome_cidade_exterior", "text", ("nome_cidade_exterior",)),
        ("pais_cod", "smallint", ("pais",)),
        ("data_inicio_atividade", "date", ("data_inicio_atividade",)),
        ("cnae_fiscal_principal", "int", ("cnae_principal",)),
        ("tipo_logradouro", "text", ("tipo_logradouro",)),
        ("logradouro", "text", ("logradouro",)),
        ("numero", "text", ("numero",)),
        ("complemento", "text", ("complemento",)),
        ("bairro", "text", ("bairro",)),
        ("cep", "text", ("cep",)),
        ("uf", "state", ("uf",)),
        ("municipio_cod", "int", ("municipio",)),
        ("ddd_telefone_1", "phone", ("ddd_1", "telefone_1")),
        ("ddd_telefone_2", "phone", ("ddd_2", "telefone_2")),
        ("ddd_fax", "phone", ("ddd_fax", "fax")),
        ("email", "text", ("correio_eletronico",)),
        ("situacao_especial", "text", ("situacao_especial",)),
        ("data_situacao_especial", "date", ("data_situacao_especial",)),
    ),
    "socio": (
        ("cnpj_basico", "as is", ("cnpj_basico",)),
        ("identificador_socio", "smallint", ("identificador_socio",)),
        ("nome_socio", "text", ("nome_socio",)),
        ("cnpj_cpf_socio", "text", ("cnpj_cpf_socio",)),
        ("qualificacao_socio_cod", "smallint", ("qualificacao_socio",)),
        ("data_entrada_sociedade", "date", ("data_entrada_sociedade",)),
        ("pais_cod", "smallint", ("pais",)),
        ("cpf_representante", "text", ("cpf_representante",)),
        ("nome_representante", "text", ("nome_representante",)),
        ("qualificacao_repr_cod", "smallint", ("qualificacao_repr",)),
        ("faixa_etaria_cod", "smallint", ("faixa_etaria",)),
    ),
    "simples": (
        ("cnpj_basico", "as is", ("cnpj_basico",)),
        ("opcao_simples", "flag", ("opcao_simples",)),
        ("data_opcao_simples", "date", ("data_opcao_simples",)),
        ("data_exclusao_simples", "date", ("data_exclusao_simples",)),
        ("opcao_mei", "flag", ("opcao_mei",)),
        ("data_opcao_mei", "date", ("data_opcao_mei",)),
        ("data_exclusao_mei", "date", ("data_exclusao_mei",)),
    ),
    "regime_tributario": (
        ("cnpj", "digits", ("cnpj",)),
        ("cnpj_basico", "base of digits", ("cnpj",)),
        ("ano", "smallint", ("ano",)),
        ("forma_de_tributacao", "as is", ("forma_de_tributacao",)),
        ("qtd_escrituracoes", "int", ("quantidade_de_escrituracoes",)),
        ("cnpj_da_scp", "partnership", ("cnpj_da_scp",)),
    ),
}

# Staging feed, key and required columns of each typed table.
FACT_FEEDS = {
    "empresa": "empresas",
    "estabelecimento": "estabelecimentos",
    "socio": "socios",
    "simples": "simples",
    "regime_tributario": "regime",
}
FACT_KEYS = {
    "empresa": ("cnpj_basico",),
    "estabelecimento": ("cnpj", "uf"),
    "estabelecimento_cnae_secundario": ("cnpj", "cnae_cod"),
    "simples": ("cnpj_basico",),
}
REQUIRED = {
    "empresa": ("cnpj_basico",),
    "estabelecimento": ("cnpj", "cnpj_basico", "uf"),
    "estabelecimento_cnae_secundario": ("cnpj", "cnae_cod"),
    "socio": ("cnpj_basico",),
    "simples": ("cnpj_basico",),
    "regime_tributario": ("cnpj", "cnpj_basico", "ano", "forma_de_tributacao"),
}

# Lookup dimensions: staging feed, code type, name of the text column.
LOOKUPS = {
    "dim_cnae": ("cnaes", "int", "descricao"),
    "dim_natureza_juridica": ("naturezas", "smallint", "descricao"),
    "dim_qualificacao": ("qualificacoes", "smallint", "descricao"),
    "dim_pais": ("paises", "smallint", "nome"),
    "dim_motivo_situacao": ("motivos", "smallint", "descricao"),
    "dim_municipio": ("municipios", "int", "nome"),
}

# Seeded domain dimensions.
DOMAINS = {
    "dim_situacao_cadastral": (
        (1, "Nula"), (2, "Ativa"), (3, "Suspensa"), (4, "Inapta"), (8, "Baixada"),
    ),
    "dim_matriz_filial": ((1, "Matriz"), (2, "Filial")),
    "dim_porte": (
        (0, "Não informado"), (1, "Micro empresa"), (3, "Empresa de pequeno porte"),
        (5, "Demais"),
    ),
    "dim_identificador_socio": (
        (1, "Pessoa jurídica"), (2, "Pessoa física"), (3, "Estrangeiro"),
    ),
    "dim_faixa_etaria": (
        (0, "Não se aplica"), (1, "0 a 12 anos"), (2, "13 a 20 anos"),
        (3, "21 a 30 anos"), (4, "31 a 40 anos"), (5, "41 a 50 anos"),
        (6, "51 a 60 anos"), (7, "61 a 70 anos"), (8, "71 a 80 anos"),
        (9, "Maiores de 80 anos"),
    ),
}
ACTIVE = 2  # fixed value: code of an active establishment
