"""Checks on keys, required columns and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def guard_not_null(df: DataFrame, cols: Sequence[str], table: str = "table") -> DataFrame:
    """The same rows, but reading a NULL in a required column fails the job.

    The guard sits in the projection, so it costs no pass of its own.
    """
    guarded = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{table}.{c} must not be null")))
        .otherwise(F.col(c))
        for c in cols
    }
    return df.withColumns(guarded)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, nulls)`` for the required columns, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols])
    return counts.select(F.inline(pairs))


def split_not_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantined)`` by the required columns."""
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    return df.filter(~missing), df.filter(missing)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], table: str = "table") -> None:
    repeated = duplicate_keys(df, keys).limit(5).collect()
    if repeated:
        raise ValueError(f"{table} is not unique on {tuple(keys)}: {repeated}")


def orphan_codes(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str = "codigo") -> DataFrame:
    """Codes of the fact that the dimension lacks, with their row counts.

    Counting comes first: the anti join sees one row per code, however hot the code.
    """
    used = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("linhas"))
    return used.join(dim.select(F.col(dim_key).alias(fk)), fk, "left_anti")
