"""Seeded domain dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiscope.schemas import DOMAINS


def domain_dim(spark: SparkSession, name: str) -> DataFrame:
    """``(codigo, descricao)`` of a fixed domain, as an inline table of known size."""
    rows = ", ".join(f"({code}S, '{text}')" for code, text in DOMAINS[name])
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(codigo, descricao)")
