"""Write DataFrames of text as the raw feeds come: quoted CSV, plain or in zip archives."""

from __future__ import annotations

from pyspark.sql import DataFrame

from regiscope.sources.feeds import write_zip_csv


def write_archives(df: DataFrame, folder: str, prefix: str, **options) -> str:
    """One archive (or plain file) per partition, through the library's sink; returns the folder."""
    return write_zip_csv(df, folder, prefix, **options)
