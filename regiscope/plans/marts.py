"""The two published aggregates and the report over one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.operators.aggregates import mart_active_by_place_activity, mart_capital_by_category
from regiscope.operators.lookup import decode
from regiscope.operators.quality import assert_unique
from regiscope.plans.publish import commit, read_table, write_version

CAPITAL = "mart_capital_by_category"
ACTIVE = "mart_active_by_place_activity"
MART_KEYS = {
    CAPITAL: ("natureza_juridica_cod",),
    ACTIVE: ("uf", "municipio_cod", "cnae_fiscal_principal"),
}
# Default and largest number of ranks of a request; for ``clamp_limit``.
DEFAULT_LIMIT, MAX_LIMIT = 10, 200


def write_marts(spark: SparkSession, root: str, empresa: DataFrame, estab: DataFrame,
                version: str | None = None) -> dict[str, str]:
    """Write new versions of both aggregates, check their keys, and return the paths."""
    made = {
        CAPITAL: mart_capital_by_category(empresa),
        ACTIVE: mart_active_by_place_activity(estab),
    }
    paths = {name: write_version(df, root, name, version=version) for name, df in made.items()}
    for name, path in paths.items():
        assert_unique(spark.read.parquet(path), MART_KEYS[name], name)
    return paths


def refresh_marts(spark: SparkSession, root: str, month: str | None = None) -> None:
    """Recompute both aggregates from the current tables; readers switch over at the commit."""
    empresa = read_table(spark, root, "empresa")
    estab = read_table(spark, root, "estabelecimento")
    commit(spark, root, write_marts(spark, root, empresa, estab), month)


def capital_ranking(tables: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Categories by total capital, largest first, the first ``limit`` or all. Reads the published aggregate when there is one."""
    mart = tables.get(CAPITAL)
    if mart is None:
        mart = mart_capital_by_category(tables["empresa"])
    named = decode(mart, tables["dim_natureza_juridica"], "natureza_juridica_cod", "natureza_juridica")
    ranked = named.orderBy(F.desc_nulls_last("capital_total"), F.asc_nulls_last("natureza_juridica_cod"))
    out = ranked.select("natureza_juridica", "empresas", "capital_total")
    return out if limit is None else out.limit(limit)
