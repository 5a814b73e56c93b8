"""Decode codes through dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.session import checkpointed


def decode(df: DataFrame, dim: DataFrame, fk: str, out: str, text: str = "descricao",
           code: str = "codigo") -> DataFrame:
    """LEFT JOIN to a code/text dimension; unknown codes keep the row with a NULL text.

    No broadcast hint: Spark broadcasts the dimension when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution
    splits a hot code.
    """
    side = dim.select(F.col(code).alias("_code"), F.col(text).alias(out))
    return df.join(side, F.col(fk) == F.col("_code"), "left").drop("_code")


# Distinct short keys that any executor can hold as a broadcast.
MAX_BROADCAST_KEYS = 200_000


def key_list(df: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """Distinct keys, fixed in the shared folder, and whether they are few enough to broadcast."""
    keys = checkpointed(df.select(key).filter(F.col(key).isNotNull()).distinct())
    return keys, keys.count() <= MAX_BROADCAST_KEYS
