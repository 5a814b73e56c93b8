"""One row per key, whole-row distinct, and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiscope.session import checkpointed


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark cut every key to one row per task before the shuffle
    (``WindowGroupLimit``), so a key that holds a third of the rows ships one row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows of each key in the given order; cut per task like ``keep_first``."""
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    )
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def with_surrogate_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, not dense, ids without a shuffle; written tables make them permanent."""
    return df.select((F.monotonically_increasing_id() + 1).alias(name), "*")


def with_dense_id(df: DataFrame, order_cols: Sequence[Column | str], name: str = "id") -> DataFrame:
    """Ids 1..n in the given order.

    A range sort spreads the rows, and a running number, fixed by a checkpoint, lets it cut
    even a long run of ties. A second checkpoint fixes which row lies in which partition. The
    offsets are one row per partition, so no row passes through a single task.
    """
    position = F.monotonically_increasing_id()
    arrived = checkpointed(df.withColumn("_tie", F.monotonically_increasing_id()))
    placed = checkpointed(
        arrived.orderBy(*order_cols, "_tie")
        .withColumn("_part", F.shiftright(position, 33))
        .withColumn("_pos", position.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + F.col("_pos") + 1).alias(name), *df.columns)
