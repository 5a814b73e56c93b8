"""Request parameters: id shapes, optional integers and row limits."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = re.compile(r"[+-]?[0-9]+")


def optional_int(value: object) -> int | None:
    """An integer from user input, or None when it is absent or not one."""
    text = "" if value is None else str(value)
    if not _INTEGER.fullmatch(text):
        return None
    number = int(text)
    return number if -(2**63) <= number < 2**63 else None


def clamp_limit(value: object, default: int, maximum: int) -> int:
    """Missing, invalid and non-positive limits give the default; large ones the maximum."""
    number = optional_int(value)
    if number is None or number <= 0:
        return default
    return min(number, maximum)


def split_registry_id(c: Column) -> Column:
    """Struct ``(cnpj_basico, consultado, valid)``: 8 characters name a company, 14 a branch."""
    size = F.length(c)
    return F.struct(
        F.when(size.isin(8, 14), F.substring(c, 1, 8)).alias("cnpj_basico"),
        F.when(size == 14, c).alias("consultado"),
        F.coalesce(size.isin(8, 14), F.lit(False)).alias("valid"),
    )
