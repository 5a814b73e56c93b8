"""Partner network: companies linked to a partner's document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.operators.dedup import top_per_key
from regiscope.operators.lookup import decode, key_list

# Default and largest number of rows per document of a request; for ``clamp_limit``.
DEFAULT_LIMIT, MAX_LIMIT = 50, 500
# From this limit on, a document's links are cut in parts first, so that none meets in one task whole.
_CUT_IN_PARTS, _PARTS = 1000, 64
_COLUMNS = ("cnpj_basico", "razao_social", "nome_socio", "qualificacao")


def _order():
    return [
        F.asc_nulls_last("cnpj_basico"),
        F.asc_nulls_last("nome_socio"),
        F.asc_nulls_last("qualificacao_socio_cod"),
    ]


def _links(socio: DataFrame) -> DataFrame:
    return socio.select("cnpj_cpf_socio", "cnpj_basico", "nome_socio", "qualificacao_socio_cod")


def _first(links: DataFrame, n: int) -> DataFrame:
    if n >= _CUT_IN_PARTS:
        part = F.pmod(F.xxhash64("cnpj_basico", "nome_socio", "qualificacao_socio_cod"), F.lit(_PARTS))
        links = top_per_key(links.withColumn("_in", part), ["cnpj_cpf_socio", "_in"], _order(), n).drop("_in")
    return top_per_key(links, ["cnpj_cpf_socio"], _order(), n)


def partner_network(tables: dict[str, DataFrame], doc: str, limit: int | None = None) -> DataFrame:
    """Companies of one document, the first ``limit`` or all.

    A limit comes before the joins. Up to ``MAX_LIMIT`` it bounds the keys, so they can be broadcast to the
    company scan, and what is left of the companies (unique by key) can be broadcast back:
    neither table is shuffled.
    """
    if not doc:
        raise ValueError("a partner document is required")
    hits = _links(tables["socio"]).filter(F.col("cnpj_cpf_socio") == doc)
    if limit is not None:
        hits = hits.orderBy(*_order()).limit(limit)
    companies = tables["empresa"].select("cnpj_basico", "razao_social")
    if limit is not None and limit <= MAX_LIMIT:
        wanted = F.broadcast(hits.select("cnpj_basico").distinct())
        companies = F.broadcast(companies.join(wanted, "cnpj_basico", "left_semi"))
    named = hits.join(companies, "cnpj_basico", "left")
    out = decode(named, tables["dim_qualificacao"], "qualificacao_socio_cod", "qualificacao")
    return out.orderBy(*_order()).select(*_COLUMNS)


def partner_network_batch(tables: dict[str, DataFrame], docs: DataFrame, limit: int | None = None) -> DataFrame:
    """The same for every document of a DataFrame with ``cnpj_cpf_socio``.

    A document may have most of the links. Without a limit they are joined, not ranked. A small
    cut runs in every task before the shuffle; a large one, which Spark plans no such cut for,
    is made in parts of a document first. A list of documents too long to broadcast is applied
    after a cut, since a shuffled join before it would bring a hot document to one task whole.
    """
    wanted, few = key_list(docs, "cnpj_cpf_socio")
    links = _links(tables["socio"])
    if few:
        links = links.join(F.broadcast(wanted), "cnpj_cpf_socio", "left_semi")
    top = links if limit is None else _first(links, limit)
    if not few:
        top = top.join(wanted, "cnpj_cpf_socio")
    named = top.join(tables["empresa"].select("cnpj_basico", "razao_social"), "cnpj_basico", "left")
    out = decode(named, tables["dim_qualificacao"], "qualificacao_socio_cod", "qualificacao")
    return out.select("cnpj_cpf_socio", *_COLUMNS)
