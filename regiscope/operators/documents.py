"""Company documents: a company with its branches, partners, flags and tax regimes nested.

Arrays are built per (company, page). An ordinary company has one page and so one row. A
company with more than ``page_size`` rows of some child is spread over as many pages as that
child needs: every page repeats the company's own fields and holds a disjoint, sorted part of
the children. Nothing is dropped, and no task has to hold a hot company whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.functions.ids import split_registry_id
from regiscope.operators.branches import decode_branches
from regiscope.operators.dedup import with_surrogate_id
from regiscope.operators.lookup import decode, key_list
from regiscope.session import checkpointed

KEY = "cnpj_basico"
PAGE_SIZE = 50_000
# Rows of the list of hot companies that may be broadcast (a key and a number each).
_BROADCAST_HOT = 500_000

BRANCH_FIELDS = (
    "cnpj", "consultado", "matriz_filial", "nome_fantasia", "situacao", "data_situacao_cadastral",
    "cnae_principal", "data_inicio_atividade", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "municipio", "uf", "ddd_telefone_1", "email",
)
PARTNER_FIELDS = ("nome_socio", "cnpj_cpf_socio", "qualificacao", "data_entrada_sociedade")
SIMPLES_FIELDS = (
    "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
)
REGIME_FIELDS = ("cnpj", "ano", "forma_de_tributacao", "qtd_escrituracoes", "cnpj_da_scp")


@dataclass
class Child:
    """Rows to nest: output array, order (nulls last) and the fields of an element.

    ``row_id`` names columns that tell rows apart, for spreading a hot company's rows.
    """

    name: str
    rows: DataFrame
    order: list[Column]
    fields: tuple[str, ...]
    row_id: tuple[str, ...]

    def spreadable(self) -> DataFrame:
        """The rows with columns that tell even exact copies apart; written ids if there are
        none, because ids made on the fly could change when a task is run again."""
        if all(c in self.rows.columns for c in self.row_id):
            return self.rows
        return checkpointed(with_surrogate_id(self.rows, self.row_id[0]))


# Child array of each table.
CHILD_TABLES = {
    "estabelecimentos": "estabelecimento", "qsa": "socio", "regime_tributario": "regime_tributario",
}
HOT_TABLE = "hot_companies"


def hot_companies(tables: dict[str, DataFrame], page_size: int = PAGE_SIZE) -> DataFrame:
    """``(cnpj_basico, child, n)`` of companies with more than ``page_size`` rows of a child.

    Counts are combined per task before the shuffle, so a hot company is no burden here.
    """
    counts = [
        tables[table].groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > page_size)
        .select(KEY, F.lit(child).alias("child"), "n")
        for child, table in CHILD_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _last_null(c: str) -> list[Column]:
    return [F.col(c).isNull(), F.col(c)]


def _nested(child: Child, rows: DataFrame, keys: list[str]) -> DataFrame:
    """One sorted array per key. Order columns lead the struct; the fields are a struct of
    their own inside it, so that dropping the order copies nothing.

    The rows are brought together first. Collecting before the shuffle would build arrays
    per task that are as large as the rows and are only merged again.
    """
    lead = [c.alias(f"_o{i}") for i, c in enumerate(child.order)]
    element = F.struct(*lead, F.struct(*child.fields).alias("fields"))
    arrays = rows.select(*keys, element.alias("_e")).repartition(*keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_e")).alias("_sorted")
    )
    return arrays.select(*keys, F.col("_sorted")["fields"].alias(child.name))


def _children(tables: dict[str, DataFrame], highlight: str | DataFrame | None) -> list[Child]:
    branches = decode_branches(tables, tables["estabelecimento"])
    if isinstance(highlight, DataFrame):
        branches = branches.join(highlight.withColumn("consultado", F.lit(True)), "cnpj", "left")
        asked = F.coalesce("consultado", F.lit(False))
    else:
        asked = F.coalesce(F.col("cnpj") == F.lit(highlight), F.lit(False))
    branches = branches.withColumn("consultado", asked)
    partners = decode(tables["socio"], tables["dim_qualificacao"], "qualificacao_socio_cod", "qualificacao")
    return [
        Child("estabelecimentos", branches, _last_null("matriz_filial_cod") + [F.col("cnpj")],
              BRANCH_FIELDS, ("cnpj", "uf")),
        Child("qsa", partners, _last_null("nome_socio"), PARTNER_FIELDS, ("id",)),
        Child("regime_tributario", tables["regime_tributario"], [-F.col("ano"), F.col("cnpj")],
              REGIME_FIELDS, ("id",)),
    ]


def _documents(tables: dict[str, DataFrame], keys: DataFrame | None, page_size: int,
               hot: DataFrame | None, highlight: str | DataFrame | None = None) -> DataFrame:
    """Documents; ``highlight`` is a branch id to mark or a table of distinct ones (``cnpj``)."""
    own = tables
    if keys is not None:
        only, few = key_list(keys, KEY)
        if hot is None and not few:
            # Counting before the join keeps a hot company from meeting it in one task.
            hot = checkpointed(hot_companies(tables, page_size))
        side = F.broadcast(only) if few else only
        own = {
            name: df.join(side, KEY, "left_semi") if KEY in df.columns else df
            for name, df in tables.items()
        }
    if hot is None:
        hot = checkpointed(hot_companies(own, page_size))
    root = decode(own["empresa"], tables["dim_natureza_juridica"], "natureza_juridica_cod", "natureza_juridica")
    root = decode(root, tables["dim_porte"], "porte_cod", "porte")
    root = root.select(KEY, "razao_social", "natureza_juridica", "capital_social", "porte")
    flags = own["simples"].select(KEY, F.struct(*SIMPLES_FIELDS).alias("simples"))
    root = root.join(flags, KEY, "left")

    children = _children(own, highlight)
    hot = hot.filter(F.col("n") > page_size).withColumn(
        "pages", F.ceil(F.col("n") / page_size).cast("int")
    )
    found = hot.count()
    if found == 0:
        keyed = [KEY]
        root = root.select("*", F.lit(0).alias("page"), F.lit(1).alias("pages"))
        parts = [_nested(c, c.rows, keyed) for c in children]
    else:
        def small(df: DataFrame) -> DataFrame:
            return F.broadcast(df) if found <= _BROADCAST_HOT else df

        keyed = [KEY, "page"]
        pages = small(hot.groupBy(KEY).agg(F.max("pages").alias("pages")))
        root = _per_page(root, pages)
        parts = []
        for c in children:
            mine = small(hot.filter(F.col("child") == c.name).select(KEY, F.col("pages").alias("_pages")))
            spread = F.pmod(F.xxhash64(*c.row_id), F.col("_pages")).cast("int")
            paged = c.spreadable().join(mine, KEY, "left")
            parts.append(_nested(c, paged.withColumn("page", F.coalesce(spread, F.lit(0))), keyed))

    for child, part in zip(children, parts):
        root = root.join(part, keyed, "left").withColumn(
            child.name, F.coalesce(child.name, F.array().cast(part.schema[child.name].dataType))
        )
    return root


def _per_page(df: DataFrame, pages: DataFrame) -> DataFrame:
    """Each row once per page of its company, with ``page`` and ``pages``."""
    counted = df.join(pages, KEY, "left").withColumn("pages", F.coalesce("pages", F.lit(1)))
    return counted.select("*", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"))


def _hot_list(tables: dict[str, DataFrame], page_size: int, hot: DataFrame | None) -> DataFrame | None:
    if hot is None and page_size >= PAGE_SIZE:
        return tables.get(HOT_TABLE)
    return hot


def company_documents(tables: dict[str, DataFrame], keys: DataFrame | None = None,
                      highlight: str | None = None, page_size: int = PAGE_SIZE,
                      hot: DataFrame | None = None) -> DataFrame:
    """One row per company and page, for all companies or those of ``keys`` (``cnpj_basico``).

    ``highlight`` is a 14-character branch id to mark. ``hot`` is a list made by
    ``hot_companies`` for the same data with at most this page size; a published registry
    carries one, otherwise one counting pass finds the companies that need pages.
    """
    documents = _documents(tables, keys, page_size, _hot_list(tables, page_size, hot), highlight)
    return documents.withColumn("cnpj_consultado", F.lit(highlight).cast("string"))


def company_document(tables: dict[str, DataFrame], registry_id: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """The document of one company, by its 8-character id or by a branch's 14 characters: one row
    per page, so one row unless the company has more than ``page_size`` rows of some child.

    The key is a literal filter on every scan. An unknown company gives no row.
    """
    if len(registry_id) not in (8, 14):
        raise ValueError("a registry id has 8 or 14 characters")
    company = F.col(KEY) == registry_id[:8]
    own = {
        name: df.filter(company) if KEY in df.columns else df for name, df in tables.items()
    }
    return company_documents(own, highlight=registry_id if len(registry_id) == 14 else None,
                             page_size=page_size)


def enrich(requests: DataFrame, tables: dict[str, DataFrame], id_col: str = "registry_id",
           page_size: int = PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """``(answers, documents)`` for many requested ids at once; they meet on ``cnpj_basico``.

    ``answers`` has a row per request: its own columns, ``cnpj_basico``, ``cnpj_consultado`` (the
    id, if it is a branch's), ``valid`` (8 or 14 characters) and ``found`` (the company exists).
    ``documents`` has a row per company asked for and page, with ``consultado`` set on every branch
    that some request names. A company is nested once however many of its branches are asked
    for, so both grow with the requests and the companies, never with their product.
    """
    shaped = split_registry_id(F.col(id_col))
    asked = requests.withColumn("_id", shaped).select(
        *requests.columns, F.col("_id.cnpj_basico").alias(KEY),
        F.col("_id.consultado").alias("cnpj_consultado"), F.col("_id.valid").alias("valid"),
    )
    known = tables["empresa"].select(KEY, F.lit(True).alias("found"))
    answers = asked.join(known, KEY, "left").withColumn("found", F.coalesce("found", F.lit(False)))
    marked = asked.select(F.col("cnpj_consultado").alias("cnpj")).filter("cnpj is not null").distinct()
    documents = _documents(tables, asked.filter("valid").select(KEY), page_size,
                           _hot_list(tables, page_size, None), marked)
    return answers, documents


def to_documents(df: DataFrame, name: str = "document") -> DataFrame:
    """Each row (of documents: a company and page) as one JSON text, NULL fields included."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))
