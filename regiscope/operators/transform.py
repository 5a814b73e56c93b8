"""Typed projections of the all-text staging feeds.

Each typed table is declared in ``regiscope.schemas.TYPED_COLUMNS`` as (column, kind, staging
columns); a kind says how the text becomes a value. One projection, one filter and at most one
shuffle (the de-duplication by key) make a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.functions import clean
from regiscope.operators.dedup import keep_first
from regiscope.operators.quality import guard_not_null, split_not_null
from regiscope.schemas import (
    ARRIVAL, FACT_FEEDS, FACT_KEYS, LOOKUPS, REQUIRED, TYPED_COLUMNS,
)

# Name prefix of the tables of rejected rows.
REJECTS = "rejects_"
# Kinds whose text may fail to parse; everything else always yields a value or NULL.
_PARSED = ("smallint", "int", "money", "date")


def _value(kind: str, cols: list[Column], strict: bool) -> Column:
    first = cols[0]
    match kind:
        case "as is":
            return first
        case "text":
            return clean.blank_to_null(first)
        case "smallint" | "int":
            return clean.to_number(first, kind, strict)
        case "money":
            return clean.to_money(first, strict)
        case "date":
            return clean.parse_date(first, strict)
        case "flag":
            return clean.yes_no(first)
        case "state":
            return clean.state_or_unknown(first)
        case "phone":
            return clean.phone(*cols)
        case "joined":
            return F.concat(*cols)
        case "digits":
            return clean.digits_only(first)
        case "base of digits":
            return clean.base_id(clean.digits_only(first))
        case "partnership":
            return clean.partnership_id(first)
    raise ValueError(f"unknown kind {kind}")


def _present(kind: str, c: Column) -> Column:
    """Whether the text holds something that has to parse."""
    if kind == "date":
        return ~F.btrim(c).isin(*clean.NO_DATE)
    return clean.not_blank(c)


def _wanted(table: str, id_pattern: str) -> Column:
    """Rows that belong in the table at all."""
    if table == "regime_tributario":
        return (
            clean.has_full_id(clean.digits_only(F.col("cnpj")))
            & clean.not_blank(F.col("ano"))
            & clean.not_blank(F.col("forma_de_tributacao"))
        )
    return clean.is_base_id(F.col("cnpj_basico"), id_pattern)


def typed(staging: DataFrame, table: str, strict: bool = True,
          id_pattern: str = clean.BASE_ID_PATTERN) -> DataFrame:
    """Filter and typed projection, still with the arrival columns the staging has."""
    columns = [
        _value(kind, [F.col(s) for s in sources], strict).alias(name)
        for name, kind, sources in TYPED_COLUMNS[table]
    ]
    arrival = [c for c in ARRIVAL if c in staging.columns]
    return staging.filter(_wanted(table, id_pattern)).select(*columns, *arrival)


def rejects(staging: DataFrame, table: str, id_pattern: str = clean.BASE_ID_PATTERN) -> DataFrame:
    """Wanted rows with an unreadable value or without a required one, and in ``_rejects`` the
    names of those columns."""
    failures = []
    for name, kind, sources in TYPED_COLUMNS[table]:
        nothing = _value(kind, [F.col(s) for s in sources], strict=False).isNull()
        if name in REQUIRED[table]:
            failures.append(F.when(nothing, F.lit(name)))
        elif kind in _PARSED:
            failures.append(F.when(_present(kind, F.col(sources[0])) & nothing, F.lit(name)))
    marked = staging.filter(_wanted(table, id_pattern)).withColumn(
        "_rejects", F.array_compact(F.array(*failures))
    )
    return marked.filter(F.size("_rejects") > 0)


def transform_fact(staging: DataFrame, table: str, strict: bool = True,
                   id_pattern: str = clean.BASE_ID_PATTERN) -> DataFrame:
    """A typed table: one row per key in arrival order, whole-row distinct for the regime
    table, every row for partners.

    A required column that is NULL fails the job; with ``strict=False`` its row is left to
    ``rejects``, and an unreadable value becomes NULL and is listed there.
    """
    rows = typed(staging, table, strict, id_pattern)
    if not strict:
        rows, _ = split_not_null(rows, REQUIRED[table])
    if table in FACT_KEYS:
        rows = keep_first(rows, FACT_KEYS[table], ARRIVAL)
    rows = rows.drop(*ARRIVAL)
    if table == "regime_tributario":
        rows = rows.distinct()
    return guard_not_null(rows, REQUIRED[table], table) if strict else rows


def transform_empresa(staging: DataFrame, **options) -> DataFrame:
    return transform_fact(staging, "empresa", **options)


def transform_estabelecimento(staging: DataFrame, **options) -> DataFrame:
    return transform_fact(staging, "estabelecimento", **options)


def transform_socio(staging: DataFrame, **options) -> DataFrame:
    return transform_fact(staging, "socio", **options)


def transform_simples(staging: DataFrame, **options) -> DataFrame:
    return transform_fact(staging, "simples", **options)


def transform_regime(staging: DataFrame, **options) -> DataFrame:
    return transform_fact(staging, "regime_tributario", **options)


def _codes(staging: DataFrame, id_pattern: str) -> DataFrame:
    """``(cnpj, _piece)``: the code texts of each branch's comma list."""
    piece = F.explode(F.split("cnae_secundaria", ",")).alias("_piece")
    pieces = staging.filter(
        clean.is_base_id(F.col("cnpj_basico"), id_pattern) & clean.not_blank(F.col("cnae_secundaria"))
    ).select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"), piece)
    return pieces.withColumn("_piece", F.btrim("_piece")).filter(clean.is_code(F.col("_piece")))


def explode_codes(staging: DataFrame, strict: bool = True,
                  id_pattern: str = clean.BASE_ID_PATTERN) -> DataFrame:
    """One row per branch and distinct secondary activity of its comma list."""
    bridge = _codes(staging, id_pattern).select("cnpj", clean.to_number(F.col("_piece"), "int", strict).alias("cnae_cod"))
    table = "estabelecimento_cnae_secundario"
    if not strict:
        bridge, _ = split_not_null(bridge, REQUIRED[table])
    return guard_not_null(bridge.distinct(), REQUIRED[table], table)


def reject_codes(staging: DataFrame, id_pattern: str = clean.BASE_ID_PATTERN) -> DataFrame:
    """``(cnpj, code)`` of the listed activities that ``explode_codes(strict=False)`` leaves out."""
    codes = _codes(staging, id_pattern).withColumnRenamed("_piece", "code")
    return codes.filter(F.col("cnpj").isNull() | clean.to_number(F.col("code"), "int", False).isNull()).distinct()


def reject_lookup(staging: DataFrame, dim: str) -> DataFrame:
    """Lookup rows that ``transform_lookup(strict=False)`` leaves out for their code or text."""
    value = clean.to_number(F.col("codigo"), LOOKUPS[dim][1], False)
    return staging.filter(clean.is_code(F.col("codigo")) & (value.isNull() | F.col("descricao").isNull()))


def transform_lookup(staging: DataFrame, dim: str, strict: bool = True) -> DataFrame:
    """A code/text dimension; the first text of a code wins."""
    _, code_type, text = LOOKUPS[dim]
    rows = staging.filter(clean.is_code(F.col("codigo"))).select(
        clean.to_number(F.col("codigo"), code_type, strict).alias("codigo"),
        F.col("descricao").alias(text),
        *ARRIVAL,
    )
    if not strict:
        rows, _ = split_not_null(rows, ("codigo", text))
    first = keep_first(rows, ("codigo",), ARRIVAL).drop(*ARRIVAL)
    first = guard_not_null(first, ("codigo", text), dim)
    if dim == "dim_municipio":
        # The feed carries neither; both stay empty until another source fills them.
        first = first.select(
            "*", F.lit(None).cast("int").alias("codigo_ibge"), F.lit(None).cast("string").alias("uf")
        )
    return first


def transform_all(staging: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    """Every typed table of a load, from its staging feeds."""
    strict = options.get("strict", True)
    out = {dim: transform_lookup(staging[spec[0]], dim, strict) for dim, spec in LOOKUPS.items()}
    for table, feed in FACT_FEEDS.items():
        out[table] = transform_fact(staging[feed], table, **options)
    out["estabelecimento_cnae_secundario"] = explode_codes(staging["estabelecimentos"], **options)
    return out


def reject_all(staging: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    """``rejects_<table>`` of every typed table: what a load with ``strict=False`` leaves out, and
    rows it takes with an unreadable value as NULL."""
    ids = {k: v for k, v in options.items() if k == "id_pattern"}
    out = {table: rejects(staging[feed], table, **ids) for table, feed in FACT_FEEDS.items()}
    out["estabelecimento_cnae_secundario"] = reject_codes(staging["estabelecimentos"], **ids)
    out |= {dim: reject_lookup(staging[spec[0]], dim) for dim, spec in LOOKUPS.items()}
    return {f"{REJECTS}{table}": rows for table, rows in out.items()}
