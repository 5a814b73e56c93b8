"""Coherent sample: some branches, and everything that belongs to their companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.operators.lookup import MAX_BROADCAST_KEYS
from regiscope.schemas import ARRIVAL, FILE, LOOKUPS


def sample_anchor(df: DataFrame, n: int, order_cols: Sequence[Column | str] = ARRIVAL) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order_cols).limit(n)


def first_archive_anchor(estabelecimentos: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of the first archive, over its members in order.

    Every task keeps the first ``n`` of its rows in order, so nothing larger is shuffled. Record
    numbers only order: those of plain files do not begin at 1.
    """
    archive = F.substring_index(FILE, "!", 1)
    first = estabelecimentos.agg(F.min(archive).alias("_first"))
    in_first = estabelecimentos.join(F.broadcast(first), archive == F.col("_first"), "left_semi")
    return sample_anchor(in_first, n)


def keep_anchored(df: DataFrame, anchor: DataFrame, n: int, key: str = "cnpj_basico") -> DataFrame:
    """Rows whose key occurs in an anchor of at most ``n`` rows."""
    keys = anchor.select(key).distinct()
    if n <= MAX_BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_semi")


def coherent_sample(staging: dict[str, DataFrame], n: int, anchor: DataFrame | None = None,
                    key: str = "cnpj_basico") -> dict[str, DataFrame]:
    """Staging feeds cut to ``n`` branches and their companies, partners and flags.

    Lookups stay whole; the regime feed is empty, as it belongs to the full load only.
    """
    if anchor is None:
        anchor = first_archive_anchor(staging["estabelecimentos"], n)
    out = {feed: staging[feed] for feed in {spec[0] for spec in LOOKUPS.values()} if feed in staging}
    out["estabelecimentos"] = anchor
    for feed in ("empresas", "socios", "simples"):
        out[feed] = keep_anchored(staging[feed], anchor, n, key)
    if "regime" in staging:
        out["regime"] = staging["regime"].filter(F.lit(False))
    return out
