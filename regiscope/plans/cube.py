"""A published cube of branch counts, and a router that answers filters from its smallest fitting grouping.

Branches are counted once by all dimensions; every other grouping is summed from those counts, which are
far fewer. Each grouping is a partition of the table, named by its columns, and the rows of each are
published with it. A question names the columns it filters or groups by; of the groupings that hold
them all the one with the fewest rows is read, and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.functions.ids import optional_int
from regiscope.plans.publish import DERIVED, write_version

DIMENSIONS = ("uf", "municipio_cod", "cnae_fiscal_principal", "situacao_cadastral")
CUBE, SIZES = f"{DERIVED}estabelecimento_cubo", f"{DERIVED}estabelecimento_cubo_linhas"
# The value of ``nivel`` that stands for no dimension at all.
TOTAL = "total"


def _name(columns: Sequence[str]) -> str:
    return "+".join(c for c in DIMENSIONS if c in columns) or TOTAL


def groupings() -> list[tuple[str, ...]]:
    """All sets of dimensions."""
    return [c for n in range(len(DIMENSIONS) + 1) for c in combinations(DIMENSIONS, n)]


def write_cube(root: str, estab: DataFrame, sets: Sequence[Sequence[str]] | None = None, version: str | None = None) -> dict[str, str]:
    """Write the groupings, all of them or ``sets``; the finest and the total are always there."""
    spark = estab.sparkSession
    wanted = {_name(s) for s in (groupings() if sets is None else sets)} | {_name(DIMENSIONS), TOTAL}
    counts = estab.groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("qtd"))
    level = F.concat_ws("+", *(F.when(F.grouping(c) == 0, F.lit(c)) for c in DIMENSIONS))
    cubed = counts.groupingSets([[F.col(c) for c in s] for s in groupings() if _name(s) in wanted], *DIMENSIONS).agg(
        F.sum("qtd").alias("qtd"), F.when(level == "", TOTAL).otherwise(level).alias("nivel"))
    rows = cubed.filter("qtd is not null")
    paths = {CUBE: write_version(rows, root, CUBE, "nivel", DIMENSIONS, version=version)}
    sizes = spark.read.parquet(paths[CUBE]).groupBy("nivel").agg(F.count(F.lit(1)).alias("linhas"))
    paths[SIZES] = write_version(sizes, root, SIZES, version=version)
    return paths


def route(tables: dict[str, DataFrame], columns: Sequence[str]) -> str:
    """The grouping with the fewest rows that holds all the columns; as many rows as there are groupings are looked at."""
    unknown = set(columns) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"no dimension: {', '.join(sorted(unknown))}")
    sizes = {r.nivel: r.linhas for r in tables[SIZES].collect()}
    fitting = [n for n in sizes if set(columns) <= set(n.split("+"))] or [_name(DIMENSIONS)]
    return min(fitting, key=lambda n: (sizes.get(n, 0), n)) if columns else TOTAL


def count_by(tables: dict[str, DataFrame], by: Sequence[str] = (), uf: str | None = None, cnae: object = None,
             situacao: object = None, municipio: object = None) -> DataFrame:
    """Branches that pass the filters that are given and readable, by the columns ``by``: these and ``qtd``.

    Without ``by`` one row, 0 if none pass.
    """
    given = {"uf": uf or None, "cnae_fiscal_principal": optional_int(cnae), "situacao_cadastral": optional_int(situacao),
             "municipio_cod": optional_int(municipio)}
    filters = {c: v for c, v in given.items() if v is not None}
    rows = tables[CUBE].filter(F.col("nivel") == route(tables, [*by, *filters]))
    for column, value in filters.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    total = F.sum("qtd")
    return rows.groupBy(*by).agg((total if by else F.coalesce(total, F.lit(0))).cast("long").alias("qtd"))
